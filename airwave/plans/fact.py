"""Fact rows, the newest batch, and the load that runs at most once per batch."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.functions.coerce import (
    column_or,
    double_column,
    flag_column,
    timestamp_column,
    whole_column,
)
from airwave.functions.numeric import round_even
from airwave.operators.joins import batches_not_in
from airwave.plans.summaries import down, up
from airwave.schema import FACT
from airwave.sinks.fact import ensure_table, load_batches

TEXT = [
    "id",
    "user_id",
    "user_login",
    "user_name",
    "game_id",
    "game_name",
    "title",
    "language",
    "viewer_trend",
]
REALS = [
    "stream_duration_minutes",
    "stream_duration_hours",
    "viewer_count_delta",
    "viewer_count_pct_change",
]


def to_fact(enriched: DataFrame) -> DataFrame:
    """The 18 fact columns of every row with a collection time.

    Text is never null, reals default to 0, times are zone-free UTC in whole seconds.
    """
    columns = {
        name: F.coalesce(column_or(enriched, name, "", "string"), F.lit("")) for name in TEXT
    }
    columns |= {name: double_column(enriched, name, 0.0).try_cast("float") for name in REALS}
    columns |= {
        name: F.date_trunc("second", timestamp_column(enriched, name)).cast("timestamp_ntz")
        for name in ("collected_at", "started_at")
    }
    columns["viewer_count"] = whole_column(enriched, "viewer_count", 0)
    columns["is_mature"] = flag_column(enriched, "is_mature")
    columns["snapshot_hour_utc"] = whole_column(enriched, "snapshot_hour_utc", to="smallint")
    return enriched.select(*[columns[name].alias(name) for name in FACT.fieldNames()]).where(
        F.col("collected_at").isNotNull()
    )


def newest(fact: DataFrame) -> DataFrame:
    """Rows of the newest batch, lazy: the maximum is a scalar subquery."""
    return fact.where(
        F.col("collected_at") == fact.agg(F.max("collected_at").alias("newest")).scalar()
    )


def newest_time(df: DataFrame, day: str | None = None) -> datetime:
    """The newest collection time: one value from one column. ValueError if there is none.

    The newest day is asked for first, unless it is known, and only its rows for their times.
    """
    if "snapshot_date" in df.columns:
        day = day or df.agg(F.max("snapshot_date").alias("day")).first()["day"]
        if day is not None:
            df = df.where(F.col("snapshot_date") == day)
    times = df.select(timestamp_column(df, "collected_at").alias("collected_at"))
    stamp = F.date_trunc("second", "collected_at").cast("timestamp_ntz")
    found = times.agg(F.max(stamp).alias("newest")).first()["newest"]
    if found is None:
        raise ValueError("no row has a valid collected_at")
    return found


def latest_batch(
    enriched: DataFrame, at: datetime | None = None, day: str | None = None
) -> tuple[DataFrame, datetime]:
    """The newest batch as fact rows, and its time.

    The time is fetched first, unless the caller knows it, so that the batch filter is a literal
    that reaches the file scan.
    """
    found = at or newest_time(enriched, day)
    kept = enriched
    if "snapshot_date" in enriched.columns:
        # The enriched table is laid out by this column.
        kept = enriched.where(F.col("snapshot_date") == found.strftime("%Y-%m-%d"))
    stamp = F.lit(found.isoformat(sep=" ")).cast("timestamp_ntz")
    return to_fact(kept).where(F.col("collected_at") == stamp), found


def load_latest_batch(
    spark: SparkSession,
    enriched: DataFrame,
    table: str,
    database: str | None = None,
    mode: str = "latest",
    day: str | None = None,
) -> dict[str, Any]:
    """Load the newest batch unless the table has it already; `day` is the newest day, if it is known.

    A batch counts as loaded once it is committed (`sinks.fact.load_batches`); one that was left half written is
    replaced. `mode="all_missing"` loads every batch the table lacks. One writer at a time is assumed.
    """
    if mode not in ("latest", "all_missing"):
        raise ValueError(f"unknown mode {mode!r}")
    name = ensure_table(spark, table, database)
    batch, newest_at = latest_batch(enriched, day=day)
    result = {"collected_at": newest_at.isoformat() + "+00:00", "table": name}
    fact = to_fact(enriched) if mode == "all_missing" else batch
    rows, replaced = load_batches(spark, fact, name)
    if rows:
        return {"status": "replaced" if replaced else "inserted", "rows": rows, **result}
    return {"status": "skipped", "rows": batch.count() if mode == "latest" else 0, **result}


def missing_batches(fact: DataFrame, loaded: DataFrame) -> DataFrame:
    """Batches of `fact` that `loaded` lacks, with their sizes."""
    return (
        batches_not_in(fact, loaded)
        .groupBy("collected_at")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("collected_at")
    )


# SQL over the fact table. The frame is bound by name, so the text is plain SQL.

COUNT_SQL = "SELECT count(*) AS row_count FROM {fact}"
TOP_SNAPSHOTS_SQL = """
SELECT collected_at, user_name, game_name, viewer_count
FROM {fact}
ORDER BY viewer_count DESC NULLS LAST, collected_at, user_name, game_name
LIMIT 10
"""


def run_sql(spark: SparkSession, text: str, fact: DataFrame, **values: Any) -> DataFrame:
    """Run SQL over the fact rows (`{fact}`) with named parameters (`:name`)."""
    return spark.sql(text, args=values or None, fact=fact)


def fact_count(spark: SparkSession, fact: DataFrame) -> DataFrame:
    return run_sql(spark, COUNT_SQL, fact)


def top_snapshots(spark: SparkSession, fact: DataFrame) -> DataFrame:
    return run_sql(spark, TOP_SNAPSHOTS_SQL, fact)


def _rounded_by(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("snapshots"),
        round_even(F.avg("viewer_count"), 2).alias("avg_viewers"),
        F.max("viewer_count").alias("peak_viewers"),
    )


def hourly_rounded(fact: DataFrame) -> DataFrame:
    return _rounded_by(fact, "snapshot_hour_utc").orderBy(up("snapshot_hour_utc"))


def games_rounded(fact: DataFrame, k: int = 15) -> DataFrame:
    return _rounded_by(fact, "game_name").orderBy(down("avg_viewers"), up("game_name")).limit(k)
