"""The fact table kept equal to the incremental enriched table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airwave.plans.fact import to_fact
from airwave.sinks.fact import ensure_table, replace_days
from airwave.streaming.enrich import read_incremental
from airwave.streaming.ingest import ONCE


def load_stream(
    enriched: DataFrame,
    out: str,
    table: str,
    checkpoint: str,
    database: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Bring the days that a stream of enriched rows touches up to date in the fact table.

    The stream says which days changed; their rows are then read as of now from `out`, where
    `enrich_stream` keeps them, and replace the day's partition. Late rows, newer versions, batches that
    arrive in parts and replayed micro-batches therefore all lead to the same table.
    """
    spark = enriched.sparkSession
    name = ensure_table(spark, table, database)

    def update(batch: DataFrame, epoch: int) -> None:
        # One value per day in the micro-batch.
        days = [r[0] for r in batch.select(F.to_date("collected_at")).distinct().collect()]
        days = sorted(day for day in days if day is not None)
        if days:
            replace_days(to_fact(read_incremental(batch.sparkSession, out, days)), name)
            # Micro-batches have a session of their own; the caller's may know the old files.
            spark.catalog.refreshTable(name)

    return (
        enriched.writeStream.foreachBatch(update)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .start()
    )
