"""Streaming ingestion: exports that arrive in a folder, and records of the REST source, are loaded batch by batch, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.values import STAGING_COLUMNS
from txnlake.plans.load import Loader
from txnlake.plans.warehouse import Warehouse
from txnlake.sources import api

SCHEMA = ", ".join(f"`{c}` string" for c in STAGING_COLUMNS)


def load_batch(warehouse: Warehouse, spark: SparkSession, name: str, **options):
    """foreachBatch: every micro-batch is a whole incremental load - validation, staging, bronze, silver, gold, run log.

    The manifest of its commit holds the stream's name and the batch's number. A batch that is run again after a crash between commit and
    checkpoint adds nothing and refreshes gold; before the commit it starts anew. So each row counts once, whenever the writer dies.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        Loader(spark, warehouse, lambda first, last: batch, source=f"stream:{name}", created_by=f"stream-{batch_id}", stream=(name, batch_id), **options).run()

    return run


def ingest(spark: SparkSession, folder: str, warehouse: Warehouse, checkpoint: str, name: str | None = None, **options):
    """Take all new CSV files of the folder and stop. name: of the stream in the warehouse, by default its checkpoint's path."""
    stream = spark.readStream.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(folder)
    return started(stream, warehouse, spark, checkpoint, name, **options)


def ingest_api(spark: SparkSession, url: str, warehouse: Warehouse, checkpoint: str, token: str | None = None, since: str | None = None, name: str | None = None, **options):
    """Take all new records of the REST source, from the last committed offset on, and stop."""
    return started(api.record_stream(spark, url, token, since), warehouse, spark, checkpoint, name, **options)


def started(stream: DataFrame, warehouse: Warehouse, spark: SparkSession, checkpoint: str, name: str | None, **options):
    run = load_batch(warehouse, spark, name or checkpoint, **options)
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_spend(events: DataFrame, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Spend for each window and type of a stream with ts, event_type and value; later rows than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def spend_cube(silver: DataFrame) -> DataFrame:
    """Spend by month and category with all subtotals."""
    return silver.cube("year_month", "category").agg(F.sum("amount_eur").alias("total"), F.count("*").alias("n"), F.grouping_id().alias("level"))
