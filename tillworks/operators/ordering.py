"""Exact global numbering, NTILE, running totals and ranks without a single-task window.

A window without a partition key, or with one very large partition, sends its rows to one task. Here
rows are range-partitioned by the whole ordering instead (its last column is unique, so equal values
spread over many partitions), numbered inside each partition, and shifted by the sizes of the
partitions before it. Only that list of sizes, one row per partition, is ever in one place. Tables of any size
take this one path, and NULLs are treated as a plain window treats them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.session import stored

_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def _columns(order: list[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _sliced(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-partitioned and sorted rows with their partition and their place in it, as a table.

    Storing them fixes the partition bounds: without it, two uses of the plan could sample different ones.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.monotonically_increasing_id()
    placed = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("_slot", slot)
    return stored(placed).select(
        *df.columns,
        F.shiftright("_slot", _ROW_BITS).cast("int").alias("_slice"),
        (F.col("_slot").bitwiseAND(F.lit(_ROW_MASK)) + 1).alias("_place"),
    )


def _before(per_slice: DataFrame, measure: str) -> DataFrame:
    """Per slice, the total of a measure over the slices before it (one row per slice); NULL where there is none."""
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.select("_slice", F.sum(measure).over(earlier).alias("_before"))


def with_position(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """1-based position of each row in the given total ordering."""
    sliced = _sliced(df, _columns(order))
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("_size"))
    offsets = F.broadcast(_before(sizes, "_size"))  # one row per partition
    position = F.col("_place") + F.coalesce("_before", F.lit(0))
    return sliced.join(offsets, "_slice").select(*df.columns, position.alias(name))


def _tile(position: Column, rows: int, tiles: int) -> Column:
    """NTILE from a position: the first ``rows % tiles`` tiles hold one row more than the others."""
    size, larger = divmod(rows, tiles)
    upto = larger * (size + 1)
    in_larger = F.floor((position - 1) / (size + 1)) + 1
    if size == 0:
        return in_larger.cast("int")
    in_smaller = larger + F.floor((position - 1 - upto) / size) + 1
    return F.when(position <= upto, in_larger).otherwise(in_smaller).cast("int")


def with_ntiles(df: DataFrame, tiles: int, scores: dict[str, list[Column | str]]) -> DataFrame:
    """One NTILE column per entry of ``scores`` (name to ordering, last ordering column unique)."""
    base = stored(df)
    rows = base.count()
    for name, order in scores.items():
        positioned = with_position(base, order, "_position")
        base = positioned.withColumn(name, _tile(F.col("_position"), rows, tiles)).drop("_position")
    return base


def with_running_total(df: DataFrame, value: str, order: list[Column | str], name: str) -> DataFrame:
    """Running total of an exact (DECIMAL or whole-number) column, up to and with the current row.

    NULLs add nothing; the total is NULL as long as no value has come.
    """
    total_type = df.select(F.sum(value)).schema[0].dataType
    sliced = _sliced(df, _columns(order))
    offsets = F.broadcast(_before(sliced.groupBy("_slice").agg(F.sum(value).alias("_sum")), "_sum"))
    in_slice = Window.partitionBy("_slice").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    inside, before = F.sum(value).over(in_slice), F.col("_before")
    joined = sliced.withColumn("_inside", inside).join(offsets, "_slice")
    upto = F.when(before.isNull(), F.col("_inside")).otherwise(before + F.coalesce("_inside", F.lit(0)))
    return joined.select(*df.columns, upto.cast(total_type).alias(name))


def with_running_totals_within(df: DataFrame, group: list[str], order: list[str], totals: dict[str, str]) -> DataFrame:
    """Running totals inside each group, up to and with the current row, also when single groups hold most rows.

    ``totals`` maps a column to the name of its total; group and order together are unique, and no column is NULL.
    """
    sliced = _sliced(df, _columns([*group, *order]))
    per_slice = sliced.groupBy("_slice", *group).agg(*[F.sum(c).alias(c) for c in totals])
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in totals]
    # one row per slice, and one more for every place where a group ends inside a slice
    offsets = per_slice.select("_slice", *group, *before)
    in_slice = Window.partitionBy("_slice", *group).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    inside = sliced.select("*", *[F.sum(c).over(in_slice).alias(f"_inside_{c}") for c in totals])
    upto = [(F.col(f"_before_{c}") + F.col(f"_inside_{c}")).alias(name) for c, name in totals.items()]
    return inside.join(offsets, ["_slice", *group]).select(*df.columns, *upto)


def with_ranks(df: DataFrame, ranks: dict[str, tuple[str, str]]) -> DataFrame:
    """RANK or DENSE_RANK by descending value, NULLs last; ``ranks`` maps a name to ('rank' | 'dense_rank', column).

    The distinct values are numbered instead of the rows, so ties cost nothing, and the ranks are joined
    back on the value.
    """
    base = stored(df)
    for name, (kind, column) in ranks.items():
        values = base.groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("_ties"))
        if kind == "dense_rank":
            ranked = with_position(values, [F.desc("_value")], "_rank")
        else:
            running = with_running_total(values, "_ties", [F.desc("_value")], "_upto")
            ranked = running.withColumn("_rank", F.col("_upto") - F.col("_ties") + 1)
        joined = base.join(ranked, F.col(column).eqNullSafe(F.col("_value")))
        base = joined.select(*base.columns, F.col("_rank").cast("int").alias(name))
    return base


def number_within(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """ROW_NUMBER inside each group, also when single groups hold a large part of all rows.

    Rows are numbered over the whole table by (group, order); a group's numbers start where the group starts.
    """
    numbered = with_position(df, [group, *order], "_position")
    starts = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("_position").alias("_first"))
    shifted = numbered.join(starts, F.col(group).eqNullSafe(F.col("_group")))
    return shifted.select(*df.columns, (F.col("_position") - F.col("_first") + 1).alias(name))
