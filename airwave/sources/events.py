"""Snapshots made from a generic event table, for queries over the host's test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEYED = [
    "*",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
    "CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ) AS batch",
    "CAST(user_id AS STRING) AS stream",
]

SNAPSHOT = [
    "event_id AS ingest_seq",
    "stream AS id",
    "stream AS user_id",
    "concat('user_', stream) AS user_login",
    "concat(IF(user_id % 10 = 0, 'üser', 'User'), stream) AS user_name",
    "event_type AS game_id",
    "IF(k % 20 = 7, NULL, event_type) AS game_name",
    "'live' AS type",
    "props AS title",
    "IF(k = 50, 'n/a', CAST(floor(value * value) AS STRING)) AS viewer_count",
    "IF(k = 99, NULL, timestampadd(MINUTE, (2 - k) * 10, batch)) AS started_at",
    "CASE k % 6 WHEN 0 THEN 'en' WHEN 1 THEN 'es' WHEN 2 THEN 'pt' WHEN 3 THEN 'de' "
    "WHEN 4 THEN 'zh-cn' END AS language",
    "CAST(NULL AS STRING) AS thumbnail_url",
    "CAST(NULL AS STRING) AS tag_ids",
    "CASE k % 4 WHEN 1 THEN 'a' WHEN 2 THEN 'a, b' WHEN 3 THEN ' , a,,b , ' END AS tags",
    "CASE k % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'false' ELSE '' END AS is_mature",
    "batch AS collected_at",
]


def snapshots_from_events(events: DataFrame) -> DataFrame:
    """One raw snapshot row per event: the user is the stream, the hour is the batch."""
    return events.selectExpr(*KEYED).selectExpr(*SNAPSHOT)


def read_event_snapshots(spark: SparkSession, directory: str) -> DataFrame:
    return snapshots_from_events(spark.read.parquet(f"{directory}/events.parquet"))
