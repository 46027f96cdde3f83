"""Approximate counts of distinct streamers from stored, mergeable sketches.

`sketch_aggregate` folds rows to one per language, game, hour of day and maturity, whatever the number of
streamers, with a HyperLogLog sketch of these. Such rows merge: over days, and over any of the four. With
2^12 registers the standard error of an estimate is 1.6 %, so nearly all estimates are within 5 %
(`BOUND`); small counts are exact. The exact tables stay the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions.labels import audience_label, language_label
from airwave.functions.numeric import ratio
from airwave.plans.summaries import MAXIMA, MINIMA, SUMS, down, up

KEYS = ["language", "game_name", "snapshot_hour_utc", "is_mature"]
REGISTER_BITS = 12
#: Three standard errors, rounded up.
BOUND = 0.05


def sketch_aggregate(rows: DataFrame, *more: str) -> DataFrame:
    """Rows of `measures` or `pre_aggregate`, folded by KEYS (and `more`), with `streamers` as a sketch."""
    return rows.groupBy(*more, *KEYS).agg(
        *[F.sum(name).alias(name) for name in SUMS],
        *[F.max(name).alias(name) for name in MAXIMA],
        *[F.min(name).alias(name) for name in MINIMA],
        F.hll_sketch_agg("user_id", REGISTER_BITS).alias("streamers"),
    )


def _estimate() -> Column:
    return F.hll_sketch_estimate(F.hll_union_agg("streamers")).alias("unique_streamers")


def _average() -> Column:
    return ratio(F.sum("viewers"), F.sum("rows")).alias("avg_viewers")


def _hourly_by(key: str, sketched: DataFrame) -> DataFrame:
    return (
        sketched.groupBy(key, "snapshot_hour_utc")
        .agg(
            F.sum("snapshots").alias("snapshots"),
            _estimate(),
            F.sum("viewers").alias("total_viewers"),
            _average(),
            F.max("peak_viewers").alias("peak_viewers"),
        )
        .orderBy(up(key), up("snapshot_hour_utc"))
    )


def language_hourly_summary(sketched: DataFrame) -> DataFrame:
    return _hourly_by("language", sketched)


def game_hourly_summary(sketched: DataFrame) -> DataFrame:
    return _hourly_by("game_name", sketched)


def games_by_streamers(sketched: DataFrame, k: int = 12) -> DataFrame:
    return (
        sketched.groupBy("game_name")
        .agg(_estimate(), F.max("peak_viewers").alias("peak_viewers"), _average())
        .orderBy(down("unique_streamers"), up("game_name"))
        .limit(k)
    )


def languages_by_streamers(sketched: DataFrame, k: int = 10) -> DataFrame:
    return (
        sketched.groupBy("language")
        .agg(_estimate(), F.max("peak_viewers").alias("peak_viewers"))
        .orderBy(down("unique_streamers"), up("language"))
        .limit(k)
        .withColumn("language_display", language_label(F.col("language")))
    )


def audience_split(sketched: DataFrame) -> DataFrame:
    return (
        sketched.groupBy(audience_label(F.col("is_mature")).alias("audience_type"))
        .agg(_estimate(), F.max("peak_viewers").alias("peak_viewers"))
        .orderBy(up("audience_type"))
    )


TABLES = {
    "language_hourly_summary": language_hourly_summary,
    "game_hourly_summary": game_hourly_summary,
    "games_by_streamers": games_by_streamers,
    "languages_by_streamers": languages_by_streamers,
    "audience_split": audience_split,
}
