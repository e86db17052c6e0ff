"""Exact duplicates by an extendible-hash index on shared files.

1. *Directory.* The rows of each key (a 64-bit hash of the text) are counted, and the keys' rows by prefix. A bucket starts
   as the whole key space and is doubled (one more prefix bit) while it holds more rows than ``bucket_rows``; the result
   has at most 2^directory_bits lines.
2. *Owners.* Rows go to the task that owns their range of buckets and keys. There the rows of one key are chained in the
   order of their texts, which compares them byte for byte: texts that share a key stay apart, and each chain names
   the row that stays and its size for all of its rows. The result is the index, files in the shared folder.
3. *Overflow pages.* A key that alone overfills a bucket cannot be split by more bits. Its rows are dealt over pages, which
   different tasks own; what the pages say of a text is put together afterwards, a line per text and page.

Null texts count as empty, empty texts are equal to each other. A row with a null doc_id never stays while its
group has another; repeated rows share their doc_id, so they are marked alike. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import chosen_rows, whole_texts
from tillworks.session import stored

DIRECTORY_BITS = 16
BUCKET_ROWS = 100_000


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned("key", 64 - bits)


def _keyed(docs: DataFrame, key_bits: int) -> DataFrame:
    """doc_id, key (the top ``key_bits`` bits of the text's hash) and text."""
    low = 64 - key_bits
    key = F.shiftleft(F.shiftrightunsigned(F.xxhash64("text"), low), low) if low else F.xxhash64("text")
    return whole_texts(docs).select("doc_id", key.alias("key"), "text")


def key_counts(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """key and group_size, its number of rows; counted where they are read, so a key is one row per task."""
    return _keyed(docs, key_bits).groupBy("key").agg(F.count("*").alias("group_size"))


def directory(counts: DataFrame, bits: int = DIRECTORY_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """prefix -> depth of its bucket: the fewest bits at which the bucket holds at most ``bucket_rows`` rows."""
    by_prefix = counts.groupBy(_prefix(bits).alias("prefix")).agg(F.sum("group_size").alias("rows"))
    levels = by_prefix.select("prefix", "rows", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"))
    at_level = levels.withColumn("branch", F.expr(f"shiftrightunsigned(prefix, {bits} - depth)"))
    fitting = (
        at_level.groupBy("depth", "branch")
        .agg(F.sum("rows").alias("branch_rows"))
        .where((F.col("branch_rows") <= bucket_rows) | (F.col("depth") == bits))
    )
    return at_level.join(fitting, ["depth", "branch"]).groupBy("prefix").agg(F.min("depth").alias("depth"))


def _bucketed(rows: DataFrame, lines: DataFrame, bits: int) -> DataFrame:
    """Adds the bucket: the key prefix cut to the bucket's depth. ``lines`` has at most 2^bits rows."""
    cut = F.expr(f"shiftleft(shiftrightunsigned(prefix, {bits} - depth), {bits} - depth)")
    placed = rows.withColumn("prefix", _prefix(bits)).join(F.broadcast(lines), "prefix")
    return placed.withColumn("bucket", cut).drop("prefix", "depth")


def exact_groups(
    docs: DataFrame,
    key_bits: int = 64,
    directory_bits: int = DIRECTORY_BITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``key_bits`` below 64 makes keys collide, for tests of the chains.
    """
    counts = stored(key_counts(docs, key_bits))
    lines = stored(directory(counts, directory_bits, bucket_rows))
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    # Keys that overfill a bucket alone. No more than one in 1,000 of all rows each: at most 1,000 of them.
    rows = counts.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    page_rows = max(bucket_rows, rows // 1000)
    pages = F.ceil(F.col("group_size") / page_rows).cast("int")
    full = counts.where(F.col("group_size") > page_rows).select("key", pages.alias("pages"))

    page = F.pmod(F.xxhash64("doc_id"), F.coalesce("pages", F.lit(1))).cast("int")
    placed = _bucketed(_keyed(docs, key_bits), lines, directory_bits).join(F.broadcast(full), "key", "left").withColumn("page", page)
    owned = placed.repartitionByRange(owners, "bucket", "key", "page")
    chain = Window.partitionBy("bucket", "key", "page", "text")
    told = [F.max("doc_id").over(chain).alias("keep_id"), F.count("*").over(chain).alias("group_size")]
    index = stored(owned.select("doc_id", "key", "page", F.col("pages").isNotNull().alias("paged"), F.sha2("text", 256).alias("digest"), *told))

    paged = index.where("paged").drop("paged")
    per_page = stored(paged.select("key", "digest", "page", "keep_id", "group_size").distinct())
    whole = per_page.groupBy("key", "digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    by_page = per_page.select("key", "digest", "page").join(whole, ["key", "digest"])
    spread = paged.select("doc_id", "key", "digest", "page").join(by_page, ["key", "digest", "page"])
    columns = ["doc_id", "keep_id", "group_size", "digest"]
    found = index.where("NOT paged").select(columns).unionByName(spread.select(columns))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest doc_id."""
    return chosen_rows(docs, exact_groups(docs).where("kept").select("doc_id").distinct())
