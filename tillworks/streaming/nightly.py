"""The nightly load as micro-batches: new line files are appended with the guard of the batch load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillworks.functions import calendar
from tillworks.operators.loading import LOADED_PAIR, as_fact_rows, insert_if_absent, known_pairs
from tillworks.sources import schemas
from tillworks.sources.files import read_parquet_or_empty


def line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Sales lines that keep arriving as CSV files in a folder."""
    return spark.readStream.schema(schemas.SALES_ITEMS).option("header", True).csv(folder)


def append_new_lines(
    lines: DataFrame, transactions: Callable[[], DataFrame], fact_path: str, pending_path: str, progress: str
) -> StreamingQuery:
    """Each batch joins its lines to the transactions and appends the pairs the fact does not hold.

    ``transactions`` is asked anew in every batch. Lines without a transaction wait in the pending table, one
    folder per batch, and are tried again with the next one. A batch may run twice after a failure: it reads the
    folder that the batch before has left and writes its own again; its first attempt at the fact either committed
    its files, and then the guard leaves nothing to append, or it committed none. The
    fact is looked up for the batch's transactions on all days.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        waiting = read_parquet_or_empty(spark, f"{pending_path}/batch={batch_id - 1}", schemas.SALES_ITEMS)
        arrived = batch.unionByName(waiting).persist()
        headers = transactions()
        late = arrived.join(headers.select("transaction_id"), "transaction_id", "left_anti").select(*batch.columns)
        late.write.mode("overwrite").parquet(f"{pending_path}/batch={batch_id}")
        matched = arrived.join(headers, "transaction_id").withColumn("date_id", calendar.date_id(F.col("transaction_date")))
        loaded = read_parquet_or_empty(spark, fact_path, schemas.WAREHOUSE_FACT)
        as_fact_rows(insert_if_absent(known_pairs(loaded, matched), matched, LOADED_PAIR)).write.mode("append").partitionBy("date_id").parquet(fact_path)
        arrived.unpersist()

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
