"""Declared rules about keys and values, reported as one row per rule with its number of failures."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.session import stored


@dataclass(frozen=True)
class TableRules:
    """``checks`` maps a rule name to (column, condition a good row fulfils); NULL does not fail a check."""

    frame: DataFrame
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    parents: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)
    checks: dict[str, tuple[str, Column]] = field(default_factory=dict)
    non_empty: bool = False


def _row_rules(table: str, rules: TableRules) -> DataFrame | None:
    """All rules on single rows from one scan: a conditional count each, turned into rows afterwards."""
    counts: list[tuple[str, str, Column]] = [
        ("not_null", c, F.count(F.when(F.col(c).isNull(), 1))) for c in rules.not_null
    ]
    counts += [(name, c, F.count(F.when(~good, 1))) for name, (c, good) in rules.checks.items()]
    if rules.non_empty:
        counts.append(("non_empty", "*", F.when(F.count("*") == 0, 1).otherwise(0).cast("long")))
    if not counts:
        return None
    one_row = rules.frame.agg(*[count.alias(f"c{i}") for i, (_, _, count) in enumerate(counts)])
    entries = [
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), F.col(f"c{i}").alias("failures"))
        for i, (rule, column, _) in enumerate(counts)
    ]
    return one_row.select(F.inline(F.array(*entries))).select(F.lit(table).alias("table_name"), "*")


def _result(table: str, rule: str, column: str, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), "failures"
    )


def _unique(table: str, frame: DataFrame, key: str) -> DataFrame:
    """Number of key values that occur more than once. Of text keys only those that share eight bytes of hash move."""
    keys = frame.where(F.col(key).isNotNull()).select(key)
    if isinstance(frame.schema[key].dataType, T.StringType):
        marked = keys.withColumn("_mark", F.xxhash64(key))
        shared = stored(marked.groupBy("_mark").count().where("count > 1").select("_mark"))
        keys = marked.join(shared, "_mark", "left_semi")
    repeated = keys.groupBy(key).count().where("count > 1")
    return _result(table, "unique", key, repeated.agg(F.count("*").alias("failures")))


def _relationship(table: str, frame: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Number of rows whose key has no parent; keys are counted first, so a frequent key is one row."""
    keys = frame.where(F.col(key).isNotNull()).groupBy(key).count()
    known = parent.select(F.col(parent_key).alias(key))
    orphans = keys.join(known, key, "left_anti")
    return _result(table, "relationship", key, orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("failures")))


def quality_report(tables: dict[str, TableRules]) -> DataFrame:
    parts: list[DataFrame] = []
    for table, rules in tables.items():
        row_rules = _row_rules(table, rules)
        parts += [row_rules] if row_rules is not None else []
        parts += [_unique(table, rules.frame, key) for key in rules.unique]
        parts += [_relationship(table, rules.frame, key, *parent) for key, parent in rules.parents.items()]
    return reduce(DataFrame.unionByName, parts)


def split_valid(df: DataFrame, conditions: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that fulfil every condition, and the others with the names of the rules they break.

    A condition that is NULL counts as broken: a load takes only rows known to be good.
    """
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(good, F.lit(False)), F.lit(name)) for name, good in conditions.items()])
    )
    judged = df.withColumn("broken_rules", broken)
    valid = judged.where(F.size("broken_rules") == 0).drop("broken_rules")
    return valid, judged.where(F.size("broken_rules") > 0)
