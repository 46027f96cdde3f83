"""The nine reporting tables.

Seven of them group the same measures by different keys. `measures` gives each row in the form
sum / max / min, and `pre_aggregate` folds rows that share all the keys. Both frames have the same
columns and give the same tables, so one pass over the enriched table can feed all seven.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airwave.functions.coerce import (
    column_or,
    double_column,
    flag_column,
    timestamp_column,
    whole_column,
)
from airwave.functions.features import hours_observed
from airwave.functions.numeric import ratio

DIMENSIONS = [
    "user_id",
    "user_login",
    "user_name",
    "language",
    "game_name",
    "snapshot_hour_utc",
    "is_mature",
]
STREAMER = ["user_id", "user_login", "user_name"]
TEXT = ["id", "user_id", "user_login", "user_name", "game_name", "language", "viewer_trend"]

SUMS = ["snapshots", "rows", "viewers", "delta", "hours", "hours_rows"]
MAXIMA = ["peak_viewers", "last_seen_at"]
MINIMA = ["first_seen_at", "best_rank"]


def prepare(enriched: DataFrame) -> DataFrame:
    """Typed input, whether it comes from the enriched table or from a text copy of it."""
    return enriched.select(
        *[column_or(enriched, name, None, "string").alias(name) for name in TEXT],
        timestamp_column(enriched, "collected_at").alias("collected_at"),
        whole_column(enriched, "viewer_count", 0).alias("viewer_count"),
        double_column(enriched, "stream_duration_hours").alias("stream_duration_hours"),
        double_column(enriched, "viewer_count_delta", 0.0).alias("viewer_count_delta"),
        double_column(enriched, "viewer_count_pct_change").alias("viewer_count_pct_change"),
        whole_column(enriched, "snapshot_hour_utc", to="int").alias("snapshot_hour_utc"),
        double_column(enriched, "minutes_since_last_snapshot").alias(
            "minutes_since_last_snapshot"
        ),
        whole_column(enriched, "viewer_rank_in_snapshot", to="int").alias(
            "viewer_rank_in_snapshot"
        ),
        flag_column(enriched, "is_mature").alias("is_mature"),
    )


def measures(prepared: DataFrame) -> DataFrame:
    """One row per snapshot: the dimensions and the summable measures."""
    def counted(name: str) -> Column:
        return F.col(name).isNotNull().cast("bigint")

    return prepared.select(
        *DIMENSIONS,
        counted("id").alias("snapshots"),
        F.lit(1).cast("bigint").alias("rows"),
        F.col("viewer_count").alias("viewers"),
        F.col("viewer_count_delta").alias("delta"),
        F.col("stream_duration_hours").alias("hours"),
        counted("stream_duration_hours").alias("hours_rows"),
        F.col("viewer_count").alias("peak_viewers"),
        F.col("collected_at").alias("last_seen_at"),
        F.col("collected_at").alias("first_seen_at"),
        F.col("viewer_rank_in_snapshot").alias("best_rank"),
    )


def folded(keys: list[str], rows: DataFrame) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in SUMS],
        *[F.max(name).alias(name) for name in MAXIMA],
        *[F.min(name).alias(name) for name in MINIMA],
    )


def pre_aggregate(rows: DataFrame) -> DataFrame:
    """Rows of one streamer, language, game, hour of day and maturity folded into one."""
    return folded(DIMENSIONS, rows)


def _avg(total: str) -> Column:
    return ratio(F.sum(total), F.sum("rows"))


def _aggregates(*names: str) -> list[Column]:
    known = {
        "snapshots": lambda: F.sum("snapshots"),
        "unique_streamers": lambda: F.count_distinct("user_id"),
        "total_viewers": lambda: F.sum("viewers"),
        "avg_viewers": lambda: _avg("viewers"),
        "peak_viewers": lambda: F.max("peak_viewers"),
        "avg_delta": lambda: _avg("delta"),
    }
    return [known[name]().alias(name) for name in names]


def down(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def top_games_summary(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("game_name")
        .agg(
            *_aggregates("snapshots", "avg_viewers", "peak_viewers"),
            ratio(F.sum("hours"), F.sum("hours_rows")).alias("avg_stream_duration_hours"),
        )
        .orderBy(down("avg_viewers"), down("peak_viewers"), up("game_name"))
    )


def _most_frequent(name: str, total: str) -> Column:
    """The value with the largest total, the smallest on a tie; nulls are skipped."""
    candidate = F.when(F.col(name).isNotNull(), F.struct(-F.col(total), F.col(name).alias("value")))
    return F.coalesce(F.min(candidate)["value"], F.lit("Unknown"))


def streamer_summary(rows: DataFrame) -> DataFrame:
    """Per-streamer profile.

    Rows fold to one per (streamer, language, game) first, so the most frequent language and game
    come from a few rows per streamer, however many snapshots they have. The single repartition
    serves both per-value totals and the final grouping.
    """
    profile = folded([*STREAMER, "language", "game_name"], rows).repartition(*STREAMER)
    per_value = {
        "_language_rows": F.sum("rows").over(Window.partitionBy(*STREAMER, "language")),
        "_game_rows": F.sum("rows").over(Window.partitionBy(*STREAMER, "game_name")),
    }
    return (
        profile.withColumns(per_value)
        .groupBy(*STREAMER)
        .agg(
            _most_frequent("language", "_language_rows").alias("language"),
            _most_frequent("game_name", "_game_rows").alias("primary_game"),
            *_aggregates("snapshots"),
            F.min("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
            *_aggregates("avg_viewers", "peak_viewers", "avg_delta"),
            F.min("best_rank").alias("best_rank"),
        )
        .withColumn("hours_observed", F.expr(hours_observed("last_seen_at", "first_seen_at")))
        .orderBy(down("peak_viewers"), down("avg_viewers"), *[up(c) for c in STREAMER])
    )


def language_summary(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("language")
        .agg(*_aggregates("snapshots", "avg_viewers", "peak_viewers", "avg_delta"))
        .orderBy(down("avg_viewers"), up("language"))
    )


def _hourly_by(key: str, rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(key, "snapshot_hour_utc")
        .agg(
            *_aggregates(
                "snapshots", "unique_streamers", "total_viewers", "avg_viewers", "peak_viewers"
            )
        )
        .orderBy(up(key), up("snapshot_hour_utc"))
    )


def language_hourly_summary(rows: DataFrame) -> DataFrame:
    return _hourly_by("language", rows)


def game_hourly_summary(rows: DataFrame) -> DataFrame:
    return _hourly_by("game_name", rows)


def hourly_summary(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("snapshot_hour_utc")
        .agg(*_aggregates("snapshots", "avg_viewers", "peak_viewers"))
        .orderBy(up("snapshot_hour_utc"))
    )


def maturity_summary(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("is_mature")
        .agg(*_aggregates("snapshots", "avg_viewers", "peak_viewers", "avg_delta"))
        .orderBy(down("avg_viewers"), up("is_mature"))
    )


def collection_health_summary(prepared: DataFrame, approximate: bool = False) -> DataFrame:
    """Size and coverage of each batch; `approximate` trades exact distinct counts for a sketch.

    Exact counts come from two folds, by streamer (which carries the measures) and by game. Each
    combines before its shuffle, and no row is multiplied for the second count.
    """
    batch = "collected_at"
    if approximate:
        sized = prepared.groupBy(batch).agg(
            *_health_measures(),
            F.approx_count_distinct("user_id").alias("unique_streamers"),
            F.approx_count_distinct("game_name").alias("unique_games"),
        )
    else:
        by_streamer = prepared.groupBy(batch, "user_id").agg(*_health_measures())
        streamers = by_streamer.groupBy(batch).agg(
            *[(F.min if n == "least" else F.max if n == "most" else F.sum)(n).alias(n) for n in HEALTH],
            F.count("user_id").alias("unique_streamers"),
        )
        games = (
            prepared.select(F.col(batch).alias("_batch"), "game_name")
            .distinct()
            .groupBy("_batch")
            .agg(F.count("game_name").alias("unique_games"))
        )
        sized = streamers.join(games, F.col(batch).eqNullSafe(F.col("_batch")))
    return sized.select(
        batch,
        F.col("ids").alias("rows_collected"),
        "unique_streamers",
        "unique_games",
        F.col("viewers").alias("total_viewers"),
        F.col("least").alias("min_viewers"),
        ratio(F.col("viewers"), F.col("rows")).alias("avg_viewers"),
        F.col("most").alias("max_viewers"),
        ratio(F.col("minutes"), F.col("gaps")).alias("avg_minutes_since_last_snapshot"),
    ).orderBy(up(batch))


HEALTH = ["ids", "rows", "viewers", "least", "most", "minutes", "gaps"]


def _health_measures() -> list[Column]:
    gap = "minutes_since_last_snapshot"
    return [
        F.count("id").alias("ids"),
        F.count("viewer_count").alias("rows"),
        F.sum("viewer_count").alias("viewers"),
        F.min("viewer_count").alias("least"),
        F.max("viewer_count").alias("most"),
        F.sum(gap).alias("minutes"),
        F.count(gap).alias("gaps"),
    ]


def growth_order() -> list[Column]:
    """Largest gain first; ties by time and name."""
    ties = ("collected_at", "user_name", "game_name", "language", "viewer_count")
    return [down("viewer_count_delta"), *[up(c) for c in ties]]


def fastest_growing_streams(prepared: DataFrame, k: int = 50) -> DataFrame:
    """The k largest gains; falling streams fill the list when fewer than k gained."""
    return (
        prepared.orderBy(*growth_order())
        .limit(k)
        .select(
            "collected_at",
            "user_name",
            "game_name",
            "language",
            "viewer_count",
            "viewer_count_delta",
            "viewer_count_pct_change",
            "viewer_trend",
        )
    )


FROM_MEASURES = {
    "top_games_summary": top_games_summary,
    "streamer_summary": streamer_summary,
    "language_summary": language_summary,
    "language_hourly_summary": language_hourly_summary,
    "game_hourly_summary": game_hourly_summary,
    "hourly_summary": hourly_summary,
    "maturity_summary": maturity_summary,
}


def build_summaries(enriched: DataFrame, folded_rows: DataFrame | None = None) -> dict[str, DataFrame]:
    """All nine tables by name, lazy.

    `folded_rows` is a stored result of `pre_aggregate(measures(prepare(enriched)))`; with it the
    first seven tables do not read the enriched table again.
    """
    prepared = prepare(enriched)
    rows = measures(prepared) if folded_rows is None else folded_rows
    tables = {name: build(rows) for name, build in FROM_MEASURES.items()}
    tables["collection_health_summary"] = collection_health_summary(prepared)
    tables["fastest_growing_streams"] = fastest_growing_streams(prepared)
    return tables
