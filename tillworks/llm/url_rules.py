"""URL filters: a list of rules first, association rules mined from its verdicts for the rest.

*List.* A rule (host, path) fits its host and all its subdomains if the url's path starts with the rule's; of
several the longest decides.

*Mining.* The urls that the list judges are the labelled ones. Their tokens (host labels, path words, query names, and
where they stand) and their verdict are baskets; Spark's FP-growth mines the frequent sets. A rule
{tokens} -> verdict stays if its support and confidence suffice and no rule with fewer of its tokens is as confident.

*Matching.* Rules are filed by token. A url looks up its tokens and a rule fits when as many of its tokens were met as it
has. Urls with the same tokens (of those that occur in rules) are matched once, so that common tokens and hosts
cost one row per distinct set. The most confident rule decides (then support, number of tokens, name); without any
the verdict is the default.

A null url, or one without ``://``, has an empty host and path and gets the default. Repeated urls are judged alike;
an empty table gives no rows, and without labelled urls nothing is mined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.session import stored

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
SUPPORT, CONFIDENCE = 0.01, 0.9
DEFAULT = "allow"

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VERDICT = "verdict="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased): behind the first ``://`` up to / ? # or the end; path: from there up to ? # or the end."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _CAPITALS, _SMALL)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def listed(rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The deciding rule of the list (like ``net/``) for the columns host and path, and its verdict; else nulls."""
    longest_first = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    name = verdict = F.lit(None).cast("string")
    for host, path, says in reversed(longest_first):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def tokens() -> Column:
    """Distinct tokens of a url: host labels, words of the path and names in the query, each with its place."""
    labels = F.transform(F.split("host", r"\."), lambda x: F.concat(F.lit("host:"), x))
    small = F.translate("path", _CAPITALS, _SMALL)
    words = F.transform(F.split(small, r"[^a-z0-9]+"), lambda x: F.concat(F.lit("path:"), x))
    query = F.regexp_extract(F.coalesce("url", F.lit("")), r"\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    plain = F.filter(F.concat(labels, words, names), lambda x: ~x.rlike(r":[0-9]*$"))
    return F.array_distinct(plain)


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, tokens, and the list's rule and verdict (null where the list says nothing)."""
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", F.col("url")).withColumn("host", host).withColumn("path", path)
    rule, verdict = listed(rules)
    return parts.select("page_id", "host", "path", tokens().alias("tokens"), rule.alias("rule"), verdict.alias("verdict"))


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """rule_tokens, verdict, confidence and support of the rules mined from rows of tokens and verdict.

    The number of distinct tokens in rules is at most the mean number of tokens per url over ``support``.
    """
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(_VERDICT), F.col("verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.element_at("consequent", 1).startswith(_VERDICT))
    rules = rules.where(~F.exists("antecedent", lambda x: x.startswith(_VERDICT))).select(
        F.array_sort("antecedent").alias("rule_tokens"),
        F.substring(F.element_at("consequent", 1), len(_VERDICT) + 1, 100).alias("verdict"),
        "confidence",
        "support",
    )
    return _without_needless(stored(rules))


def _without_needless(rules: DataFrame) -> DataFrame:
    """Drops a rule if leaving out one of its tokens gives a rule for the same verdict that is as confident."""
    longer = rules.where(F.size("rule_tokens") > 1).select(
        F.col("rule_tokens").alias("all_tokens"), "verdict", F.col("confidence").alias("reached"), F.explode("rule_tokens").alias("one")
    )
    shorter = longer.withColumn("rule_tokens", F.array_remove("all_tokens", F.col("one")))
    needless = shorter.join(rules.drop("support"), ["rule_tokens", "verdict"]).where(F.col("confidence") >= F.col("reached"))
    needless = needless.select(F.col("all_tokens").alias("rule_tokens"), "verdict")
    return rules.join(needless, ["rule_tokens", "verdict"], "left_anti")


def _best_by_tokens(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """tokens -> verdict of the best fitting rule, for distinct token sets, through the index token -> rules."""
    named = rules.withColumn("name", F.array_join("rule_tokens", " ")).withColumn("needed", F.size("rule_tokens"))
    index = named.select("name", "verdict", "needed", "confidence", "support", F.explode("rule_tokens").alias("token"))
    met = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    hits = met.groupBy("tokens", "name", "verdict", "needed", "confidence", "support").agg(F.count("*").alias("met"))
    fitting = hits.where("met = needed")
    order = F.struct("confidence", "support", "needed", "name")
    return fitting.groupBy("tokens").agg(F.max_by("verdict", order).alias("mined"))


def url_verdicts(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    default: str = DEFAULT,
) -> DataFrame:
    """page_id, host, path, rule (of the list, else null) and verdict (the list's, else the mined rules')."""
    told = judged(pages, rules)
    labelled = stored(told.where("verdict is not null").select("tokens", "verdict"))
    if labelled.limit(1).count() == 0:
        return told.select("page_id", "host", "path", "rule", F.lit(default).alias("verdict"))
    found = stored(mined_rules(labelled, support, confidence))
    # Only tokens of rules tell urls apart. There are at most (mean tokens per url) / support of them.
    known = [row[0] for row in found.select(F.explode("rule_tokens").alias("token")).distinct().collect()]
    in_rules = F.array_intersect("tokens", F.array(*[F.lit(t) for t in sorted(known)]).cast("array<string>"))
    told = told.withColumn("tokens", F.array_sort(in_rules))
    open_ones = told.where("verdict is null").groupBy("tokens").agg(F.count("*").alias("urls"))
    # stored: of known size for the join, and its rows are dealt for it anew, so that a common set can be split
    best = stored(_best_by_tokens(open_ones, found))
    verdict = reduce(F.coalesce, [F.col("verdict"), F.col("mined"), F.lit(default)])
    return told.join(best, "tokens", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
