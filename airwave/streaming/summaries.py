"""The nine summaries kept up to date with the incremental enriched table.

For each day there are partial results that merge: the pre-aggregate behind seven of the tables, the health of the
day's batches, the day's largest gains, and sketches for approximate counts. The days that a micro-batch
touched are read as of now and their partial results replaced; other days are not read. The tables are
built from the partial results of all days, which are far fewer rows than the enriched table.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airwave.operators.dedupe import first_rows
from airwave.plans import sketches
from airwave.plans.summaries import (
    DIMENSIONS,
    FROM_MEASURES,
    collection_health_summary,
    fastest_growing_streams,
    folded,
    growth_order,
    measures,
    prepare,
)
from airwave.sinks.files import exists
from airwave.streaming.enrich import read_incremental
from airwave.streaming.ingest import ONCE
from airwave.streaming.manifest import DAY

#: Rows of the largest gains, per day and in the table.
GAINS = 50


def _replace_days(rows: DataFrame, path: str) -> None:
    laid_out = rows.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY)
    laid_out.option("partitionOverwriteMode", "dynamic").parquet(path)


def update_partials(
    spark: SparkSession, out: str, path: str, days: Iterable[date], gains: int = GAINS
) -> None:
    """Replace the partial results of some days by those of the rows that they have now.

    Repeating it, or any later update of a day, leads to the same state.
    """
    prepared = prepare(read_incremental(spark, out, list(days)))
    day = F.to_date("collected_at")
    by_day = measures(prepared).withColumn(DAY, F.to_date("last_seen_at"))
    _replace_days(folded([DAY, *DIMENSIONS], by_day), f"{path}/folded")
    # What was just stored has each streamer once per day and group.
    stored = _days_of(spark.read.parquet(f"{path}/folded"), days)
    _replace_days(sketches.sketch_aggregate(stored, DAY), f"{path}/sketches")
    _replace_days(collection_health_summary(prepared).withColumn(DAY, day), f"{path}/health")
    largest = first_rows(prepared.withColumn(DAY, day), [DAY], growth_order(), gains)
    _replace_days(largest, f"{path}/gains")


def _days_of(rows: DataFrame, days: Iterable[date]) -> DataFrame:
    return rows.where(F.col(DAY).isin([d for d in days]))


def read_summaries(spark: SparkSession, path: str, gains: int = GAINS) -> dict[str, DataFrame]:
    """All nine tables by name, lazy, from the partial results; `gains` is at most that of the updates."""
    if not exists(spark, f"{path}/folded"):
        raise FileNotFoundError(f"no partial results under {path}")

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}").drop(DAY)

    tables = {name: build(stored("folded")) for name, build in FROM_MEASURES.items()}
    tables["collection_health_summary"] = stored("health").orderBy("collected_at")
    tables["fastest_growing_streams"] = fastest_growing_streams(stored("gains"), gains)
    return tables


def read_approximate(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables with approximate counts of streamers (`plans.sketches`), from the stored sketches."""
    stored = spark.read.parquet(f"{path}/sketches").drop(DAY)
    return {name: build(stored) for name, build in sketches.TABLES.items()}


def summaries_stream(
    changes: DataFrame, out: str, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the partial results under `path` up to date with a stream of touched batch times."""

    def update(batch: DataFrame, epoch: int) -> None:
        # One value per day in the micro-batch.
        days = [r[0] for r in batch.select(F.to_date("collected_at")).distinct().collect()]
        days = sorted(d for d in days if d is not None)
        if days:
            update_partials(batch.sparkSession, out, path, days)

    return (
        changes.writeStream.foreachBatch(update)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .start()
    )
