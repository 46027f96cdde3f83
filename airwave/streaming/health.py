"""Collection health per batch, exact, as batches arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airwave.operators.dedupe import first_rows
from airwave.plans.summaries import collection_health_summary, prepare
from airwave.streaming.enrich import read_incremental
from airwave.streaming.ingest import ONCE


def health_stream(
    enriched: DataFrame, out: str, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Work out the health of every batch that a stream of enriched rows touches.

    A touched batch is read as of now from `out`, where `enrich_stream` keeps it, so rows that come late
    or in parts are counted, and distinct counts are exact. `read_health` gives the newest result.
    """

    def update(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        times = batch.select("collected_at").distinct()
        # One value per day in the micro-batch.
        days = [r[0] for r in times.select(F.to_date("collected_at")).distinct().collect()]
        if not days:
            return
        rows = read_incremental(spark, out, days).join(times, "collected_at", "left_semi")
        health = collection_health_summary(prepare(rows))
        health.write.mode("overwrite").parquet(f"{path}/batch_id={epoch}")

    return (
        enriched.writeStream.foreachBatch(update)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .start()
    )


def read_health(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch: its newest result."""
    results = spark.read.parquet(path)
    return first_rows(results, ["collected_at"], [F.col("batch_id").desc()]).drop("batch_id")
