"""From raw snapshots to the enriched table.

Deviations from lenient text processing, all on purpose: timestamps of any ISO-8601 spelling parse;
rows are compared for duplicates after times are parsed, and by their raw text where no time parses;
fractions of a viewer are cut; an absent column takes its default.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions import features as X
from airwave.functions.coerce import (
    flag_column,
    run_instant,
    text_column,
    timestamp_column,
    whole_column,
)
from airwave.operators.dedupe import first_rows
from airwave.operators.ordered import (
    SERIES,
    UNREAD,
    dense_rank_in_batch,
    stream_history,
    with_series_key,
)
from airwave.schema import DERIVED, RAW_COLUMNS

TIME = "collected_at"


def clean(raw: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Typed columns with defaults; a missing or bad collection time becomes the run time.

    `_unread` keeps what such a time was, and is empty for the others.
    """
    time = timestamp_column(raw, TIME)
    text = F.col(TIME).cast("string") if TIME in raw.columns else F.lit(None).cast("string")
    unread = F.coalesce(F.concat(F.lit("="), text), F.lit("?"))
    return raw.withColumns(
        {
            TIME: F.coalesce(time, run_instant(run_ts)),
            UNREAD: F.when(time.isNull(), unread).otherwise(""),
            "started_at": timestamp_column(raw, "started_at"),
            "viewer_count": whole_column(raw, "viewer_count", 0),
            "is_mature": flag_column(raw, "is_mature"),
            "title": text_column(raw, "title", ""),
            "language": text_column(raw, "language", "unknown"),
            "game_name": text_column(raw, "game_name", "Unknown"),
            "tags": text_column(raw, "tags", ""),
        }
    )


def _keyed(df: DataFrame) -> tuple[DataFrame, list[str]]:
    if "id" in df.columns:
        return with_series_key(df), [SERIES, TIME, UNREAD]
    return df, [TIME, UNREAD]


def _landing_order(df: DataFrame, otherwise: list[str]) -> list[Column]:
    """Landing order, which is unique per raw row; the count settles what a repeated number leaves.

    Only a table without `ingest_seq` is ordered by its columns (`otherwise`), so that a retried
    task picks the same row. Ordering by them always would make every query read them.
    """
    order = ["ingest_seq", "viewer_count"] if "ingest_seq" in df.columns else otherwise
    return [F.col(c).asc_nulls_last() for c in order]


def _first_landed(keyed: DataFrame, keys: list[str]) -> DataFrame:
    columns = [c for c in RAW_COLUMNS if c in keyed.columns and c not in ("id", TIME)]
    return first_rows(keyed, keys, _landing_order(keyed, ["viewer_count", *columns]))


def unique(cleaned: DataFrame) -> DataFrame:
    """First row per `(id, collected_at)` in landing order, with the key columns.

    Unreadable times are compared by their text; missing ones are equal.
    """
    return _first_landed(*_keyed(cleaned))


def dedupe(cleaned: DataFrame) -> DataFrame:
    """First row per `(id, collected_at)` in landing order."""
    return unique(cleaned).drop(SERIES, UNREAD)


def history_keys(cleaned: DataFrame) -> DataFrame:
    """The deduplicated rows, cut down to the columns that rank and history need.

    Landing order is among them, for rows of one id that were given the run time.
    """
    keyed, keys = _keyed(cleaned)
    needed = [c for c in (*keys, "ingest_seq", "viewer_count") if c in keyed.columns]
    narrow = keyed.select(*needed)
    return first_rows(narrow, keys, _landing_order(narrow, ["viewer_count"]))


def _with_sql(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in columns.items()})


def add_row_features(df: DataFrame) -> DataFrame:
    """Features that need nothing but the row itself."""
    first = {
        "stream_duration_minutes": X.duration_minutes(TIME, "started_at"),
        "tags_count": X.tag_count("tags"),
    }
    then = {
        "stream_duration_hours": X.duration_hours("stream_duration_minutes"),
        "snapshot_date": X.day_text(TIME),
        "snapshot_hour_utc": f"hour({TIME})",
        "snapshot_weekday": X.weekday_name(TIME),
        "is_weekend": X.on_weekend(TIME),
        "started_date": X.day_text("started_at"),
        "started_hour_utc": "hour(started_at)",
        "title_length": "char_length(title)",
        "has_tags": "tags_count > 0",
        "viewer_count_bucket": X.viewer_bucket("viewer_count"),
        "stream_age_bucket": X.age_bucket("stream_duration_minutes"),
    }
    return _with_sql(_with_sql(df, first), then)


def add_changes(df: DataFrame) -> DataFrame:
    """Change against the previous snapshot of the stream."""
    first = {
        "minutes_since_last_snapshot": X.gap_minutes(TIME, "previous_collected_at"),
        "viewer_count_delta": X.delta("viewer_count", "previous_viewer_count"),
    }
    then = {
        "viewer_count_pct_change": X.pct_change("viewer_count_delta", "previous_viewer_count"),
        "viewer_trend": X.trend("viewer_count_delta"),
    }
    return _with_sql(_with_sql(df, first), then)


def without_history(df: DataFrame) -> DataFrame:
    """History columns for rows that carry no stream id."""
    return _with_sql(
        df,
        {
            "previous_viewer_count": "CAST(NULL AS BIGINT)",
            "previous_collected_at": "CAST(NULL AS TIMESTAMP)",
            "stream_snapshot_number": "1",
            "minutes_since_last_snapshot": "CAST(NULL AS DOUBLE)",
            "viewer_count_delta": "0D",
            "viewer_count_pct_change": "0D",
            "viewer_trend": "'stable'",
        },
    )


def base(raw: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Clean, deduplicated rows with row features, without rank and history."""
    return add_row_features(dedupe(clean(raw, run_ts)))


def enrich(raw: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """The enriched table: raw columns, then the 21 derived ones. Lazy, in no particular order.

    Wide rows are shuffled once, by (id, collected_at), for the deduplication. Rank and history are
    worked out on a second, narrow read (key, time, count) and joined back on the same key.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    cleaned = clean(raw, run_ts)
    narrow = history_keys(cleaned)
    keyed, keys = _keyed(cleaned)
    # Any number of rows may have been given the run time.
    history = stream_history(narrow, [run_instant(run_ts)]) if SERIES in keys else narrow
    side = dense_rank_in_batch(history, narrow).drop("viewer_count", "ingest_seq")
    joined = add_row_features(_first_landed(keyed, keys).join(side, keys).drop(SERIES))
    full = add_changes(joined) if SERIES in keys else without_history(joined)
    return full.select(*cleaned.drop(UNREAD).columns, *DERIVED.fieldNames())


def report_order(df: DataFrame) -> list[Column]:
    """By batch, largest first. The id breaks ties and lets a range shuffle split a large batch."""
    order = [F.col(TIME).asc_nulls_last(), F.col("viewer_count").desc_nulls_last()]
    return order + ([F.col("id").asc_nulls_last()] if "id" in df.columns else [])


def in_report_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*report_order(df))
