"""Column lists and explicit schemas. Nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw snapshot columns, in file order.
RAW_COLUMNS = [
    "id",
    "user_id",
    "user_login",
    "user_name",
    "game_id",
    "game_name",
    "type",
    "title",
    "viewer_count",
    "started_at",
    "language",
    "thumbnail_url",
    "tag_ids",
    "tags",
    "is_mature",
    "collected_at",
]

# Raw text is kept as it landed; `ingest_seq` gives the landing order of rows.
RAW = T.StructType(
    [T.StructField(name, T.StringType()) for name in RAW_COLUMNS]
    + [T.StructField("ingest_seq", T.LongType())]
)

PAYLOAD_STREAM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_login", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("game_name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("viewer_count", T.LongType()),
        T.StructField("started_at", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("thumbnail_url", T.StringType()),
        T.StructField("tag_ids", T.ArrayType(T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("is_mature", T.BooleanType()),
    ]
)


def payload(stream: T.StructType = PAYLOAD_STREAM) -> T.StructType:
    """One landed page: the API's envelope plus the run it belongs to."""
    return T.StructType(
        [
            T.StructField("run_ts", T.StringType()),
            T.StructField("page_no", T.IntegerType()),
            T.StructField("data", T.ArrayType(stream)),
            T.StructField(
                "pagination", T.StructType([T.StructField("cursor", T.StringType())])
            ),
        ]
    )


CATEGORY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("box_art_url", T.StringType()),
    ]
)

# Derived columns in output order.
DERIVED = T.StructType(
    [
        T.StructField("stream_duration_minutes", T.DoubleType()),
        T.StructField("stream_duration_hours", T.DoubleType()),
        T.StructField("snapshot_date", T.StringType()),
        T.StructField("snapshot_hour_utc", T.IntegerType()),
        T.StructField("snapshot_weekday", T.StringType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("started_date", T.StringType()),
        T.StructField("started_hour_utc", T.IntegerType()),
        T.StructField("title_length", T.IntegerType()),
        T.StructField("tags_count", T.IntegerType()),
        T.StructField("has_tags", T.BooleanType()),
        T.StructField("viewer_rank_in_snapshot", T.IntegerType()),
        T.StructField("previous_viewer_count", T.LongType()),
        T.StructField("previous_collected_at", T.TimestampType()),
        T.StructField("stream_snapshot_number", T.IntegerType()),
        T.StructField("minutes_since_last_snapshot", T.DoubleType()),
        T.StructField("viewer_count_delta", T.DoubleType()),
        T.StructField("viewer_count_pct_change", T.DoubleType()),
        T.StructField("viewer_trend", T.StringType()),
        T.StructField("viewer_count_bucket", T.StringType()),
        T.StructField("stream_age_bucket", T.StringType()),
    ]
)

_TYPED = {
    "viewer_count": T.LongType(),
    "started_at": T.TimestampType(),
    "collected_at": T.TimestampType(),
    "is_mature": T.BooleanType(),
}

ENRICHED = T.StructType(
    [T.StructField(name, _TYPED.get(name, T.StringType())) for name in RAW_COLUMNS]
    + [T.StructField("ingest_seq", T.LongType())]
    + DERIVED.fields
)

# The fact table's columns. Times are zone-free UTC.
FACT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_login", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("game_name", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("viewer_count", T.LongType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("collected_at", T.TimestampNTZType()),
        T.StructField("language", T.StringType()),
        T.StructField("is_mature", T.BooleanType()),
        T.StructField("stream_duration_minutes", T.FloatType()),
        T.StructField("stream_duration_hours", T.FloatType()),
        T.StructField("snapshot_hour_utc", T.ShortType()),
        T.StructField("viewer_count_delta", T.FloatType()),
        T.StructField("viewer_count_pct_change", T.FloatType()),
        T.StructField("viewer_trend", T.StringType()),
    ]
)

# Column order of an interactively collected snapshot; unknown columns follow.
SNAPSHOT_ORDER = [
    "id",
    "user_id",
    "user_login",
    "user_name",
    "game_id",
    "game_name",
    "type",
    "title",
    "viewer_count",
    "started_at",
    "collected_at",
    "stream_duration_hours",
    "language",
    "tags",
    "is_mature",
    "thumbnail_url",
]
