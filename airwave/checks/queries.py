"""Registered queries. Each takes (spark, directory) and reads the whole `events` table.

Results are tidied for comparison with another engine: instants become zone-free, doubles are
rounded half to even at a fixed place, because their last bits depend on the order of summation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airwave.functions.labels import display_name, language_label
from airwave.functions.numeric import even_sql
from airwave.operators.joins import full_batches
from airwave.operators.ordered import (
    SERIES,
    UNREAD,
    dense_rank_in_batch,
    stream_history,
)
from airwave.plans import enrich as P
from airwave.plans import explore as Q
from airwave.plans import fact as L
from airwave.plans import summaries as A
from airwave.session import configure
from airwave.sources.events import read_event_snapshots

RUN_TS = "2026-01-01T00:00:00Z"
# Hourly test batches are small, so the full-batch threshold is too.
FULL_BATCH = 15

Query = Callable[[SparkSession, str], DataFrame]


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    def column(field: T.StructField) -> str:
        if isinstance(field.dataType, T.TimestampType):
            return f"CAST({field.name} AS TIMESTAMP_NTZ) AS {field.name}"
        if isinstance(field.dataType, T.DoubleType):
            return f"{even_sql(field.name, places)} AS {field.name}"
        return field.name

    return df.selectExpr(*[column(f) for f in df.schema.fields])


def _raw(spark: SparkSession, directory: str) -> DataFrame:
    return read_event_snapshots(configure(spark), directory)


def _cleaned(spark: SparkSession, directory: str) -> DataFrame:
    return P.clean(_raw(spark, directory), RUN_TS)


def _base(spark: SparkSession, directory: str) -> DataFrame:
    return P.base(_raw(spark, directory), RUN_TS)


def _enriched(spark: SparkSession, directory: str) -> DataFrame:
    return P.enrich(_raw(spark, directory), RUN_TS)


def _keys(spark: SparkSession, directory: str) -> DataFrame:
    return P.history_keys(_cleaned(spark, directory))


def _with_id(keyed: DataFrame) -> DataFrame:
    """The id back from its series key."""
    named = keyed.withColumn("id", F.expr(f"nullif(substr({SERIES}, 2), '')"))
    return named.drop(SERIES, UNREAD, "ingest_seq")


def _changes(spark: SparkSession, directory: str) -> DataFrame:
    """Deduplicated rows with history but without rank: for reports that use changes only."""
    history = stream_history(_keys(spark, directory)).drop("viewer_count")
    base = P.add_row_features(P.unique(_cleaned(spark, directory)))
    keys = [SERIES, "collected_at", UNREAD]
    return P.add_changes(base.join(history, keys).drop(SERIES, UNREAD))


def _picked(source: Query, *columns: str) -> Query:
    return lambda spark, directory: tidy(source(spark, directory).select(*columns))


def _over(source: Query, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, directory: tidy(build(source(spark, directory)))


def _summary(source: Query, build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over(source, lambda df: build(A.measures(A.prepare(df))))


def _sql(source: Query, build: Callable[[SparkSession, DataFrame], DataFrame]) -> Query:
    return lambda spark, directory: tidy(build(spark, L.to_fact(source(spark, directory))))


def _viewer_rank(spark: SparkSession, directory: str) -> DataFrame:
    return tidy(_with_id(dense_rank_in_batch(_keys(spark, directory))))


def _stream_history(spark: SparkSession, directory: str) -> DataFrame:
    return tidy(_with_id(stream_history(_keys(spark, directory))))


def _viewer_trend(spark: SparkSession, directory: str) -> DataFrame:
    rows = P.add_changes(_with_id(stream_history(_keys(spark, directory))))
    return tidy(
        rows.select(
            "id",
            "collected_at",
            "minutes_since_last_snapshot",
            "viewer_count_delta",
            "viewer_count_pct_change",
            "viewer_trend",
        )
    )


def _unreadable_times(spark: SparkSession, directory: str) -> DataFrame:
    """Deduplicated rows where some times are missing and others are texts that do not parse."""
    text = (
        "CASE WHEN ingest_seq % 7 = 0 THEN 'bad ' || CAST(ingest_seq % 3 AS STRING) "
        "WHEN ingest_seq % 7 <> 1 THEN CAST(collected_at AS STRING) END"
    )
    raw = _raw(spark, directory).withColumn("collected_at", F.expr(text))
    rows = P.dedupe(P.clean(raw, RUN_TS))
    return tidy(rows.select("id", "collected_at", "ingest_seq", "viewer_count"))


def _missing_batches(spark: SparkSession, directory: str) -> DataFrame:
    """Batches not yet loaded, when the table holds those of full size."""
    fact = L.to_fact(_base(spark, directory))
    return tidy(L.missing_batches(fact, full_batches(fact, FULL_BATCH)))


def _profile(spark: SparkSession, directory: str) -> DataFrame:
    return tidy(Q.profile(_raw(spark, directory), _base(spark, directory)))


def _density(spark: SparkSession, directory: str) -> DataFrame:
    """Densities are small numbers, so they keep more places than the other columns."""
    curve = Q.viewer_density(_base(spark, directory))
    return curve.selectExpr(
        "point", f"{even_sql('x', 6)} AS x", f"{even_sql('density', 12)} AS density",
        f"{even_sql('scaled', 6)} AS scaled",
    )


def _labels(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        "collected_at",
        language_label(F.col("language")).alias("language_display"),
        display_name(F.col("user_name"), F.col("user_login")).alias("streamer_display"),
    )


def _latest_batch(spark: SparkSession, directory: str) -> DataFrame:
    # Deduplication and enrichment keep all batch times, so the newest one is read from the source.
    at = L.newest_time(_cleaned(spark, directory))
    return L.latest_batch(_enriched(spark, directory), at)[0]


def _game_hourly(spark: SparkSession, directory: str) -> DataFrame:
    rows = A.measures(A.prepare(_base(spark, directory)))
    return A.game_hourly_summary(rows)


def _folded_streamers(df: DataFrame) -> DataFrame:
    """The language table again, through the pre-aggregated form the summary job stores."""
    return A.language_hourly_summary(A.pre_aggregate(A.measures(A.prepare(df))))


def registered() -> dict[str, Query]:
    return {
        "enrich_base": _over(_enriched, lambda df: df),
        "dedupe_snapshots": _picked(
            lambda s, d: P.dedupe(_cleaned(s, d)),
            "ingest_seq", "id", "user_login", "user_name", "game_name", "title", "viewer_count",
            "started_at", "language", "tags", "is_mature", "collected_at",
        ),
        "dedupe_unreadable_times": _unreadable_times,
        "durations": _picked(
            _base, "id", "collected_at", "stream_duration_minutes", "stream_duration_hours"
        ),
        "raw_durations": _over(_cleaned, Q.stream_hours),
        "calendar_features": _picked(
            _base,
            "id", "collected_at", "snapshot_date", "snapshot_hour_utc", "snapshot_weekday",
            "is_weekend", "started_date", "started_hour_utc",
        ),
        "text_features": _picked(
            _base, "id", "collected_at", "title_length", "tags_count", "has_tags"
        ),
        "display_labels": _over(lambda s, d: P.dedupe(_cleaned(s, d)), _labels),
        "viewer_rank": _viewer_rank,
        "stream_history": _stream_history,
        "viewer_trend": _viewer_trend,
        "buckets": _picked(
            _base, "id", "collected_at", "viewer_count_bucket", "stream_age_bucket"
        ),
        "top_games_summary": _summary(_base, A.top_games_summary),
        "streamer_summary": _summary(_enriched, A.streamer_summary),
        "language_summary": _summary(_changes, A.language_summary),
        "language_hourly_summary": _summary(_base, A.language_hourly_summary),
        "language_hourly_folded": _over(_base, _folded_streamers),
        "game_hourly_summary": _summary(_base, A.game_hourly_summary),
        "hourly_summary": _summary(_base, A.hourly_summary),
        "maturity_summary": _summary(_changes, A.maturity_summary),
        "collection_health_summary": _over(
            _changes, lambda df: A.collection_health_summary(A.prepare(df))
        ),
        "fastest_growing_streams": _over(
            _changes, lambda df: A.fastest_growing_streams(A.prepare(df))
        ),
        "games_by_streamers": _over(_base, Q.games_by_streamers),
        "languages_by_streamers": _over(_base, Q.languages_by_streamers),
        "audience_split": _over(_base, Q.audience_split),
        "top_streamers": _over(_base, Q.top_streamers),
        "full_batch_rows": _over(
            _base,
            lambda df: full_batches(df, FULL_BATCH).select("id", "collected_at", "viewer_count"),
        ),
        "full_batch_timeline": _over(_base, lambda df: Q.full_batch_timeline(df, FULL_BATCH)),
        "tracked_streamers": _over(_base, Q.tracked_streamers),
        "tracked_timeline": _over(_base, Q.tracked_timeline),
        "top_games_hourly": _over(_game_hourly, Q.top_games_hourly),
        "games_by_total": _over(_base, Q.games_by_total),
        "languages_by_total": _over(_base, Q.languages_by_total),
        "viewer_describe": _over(_base, Q.viewer_describe),
        "viewer_histogram": lambda s, d: tidy(Q.viewer_histogram(s, _base(s, d))),
        "viewer_density": _density,
        "mature_split": _over(_base, Q.mature_split),
        "fact_rows": _over(_enriched, L.to_fact),
        "fact_count": _sql(_base, L.fact_count),
        "top_snapshots": _sql(_base, L.top_snapshots),
        "hourly_rounded": _sql(_base, lambda s, df: L.hourly_rounded(df)),
        "games_rounded": _sql(_base, lambda s, df: L.games_rounded(df)),
        "profile": _profile,
        "latest_batch": _over(_latest_batch, lambda df: df),
        "missing_batches": _missing_batches,
    }
