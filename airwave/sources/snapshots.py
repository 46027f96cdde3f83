"""Scans of raw, enriched and summary tables, with the input guards."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airwave.operators.dedupe import union_growing
from airwave.schema import ENRICHED, RAW, RAW_COLUMNS
from airwave.sinks.files import values_of

# Titles hold commas, line breaks and doubled quotes.
CSV = {"header": "true", "multiLine": "true", "escape": '"'}


def _load(spark: SparkSession, path: str | list[str], fmt: str, schema: T.StructType | None, **options):
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table at {path}") from error
        raise


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, or ValueError when it has no row; looks for one row only."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def _with_new_fields(
    spark: SparkSession, path: str | list[str], known: T.StructType, merge: bool = True, **options
) -> T.StructType:
    """The known fields, then those that only some files have; without `merge`, one file is asked."""
    found = _load(spark, path, "parquet", None, mergeSchema=str(merge).lower(), **options).schema
    more = [f for f in found if f.name not in (*known.fieldNames(), "batch_id")]
    return T.StructType([*known.fields, *more])


def raw_schema(spark: SparkSession, path: str) -> T.StructType:
    """Fields of the raw table, new API fields included; the known ones if there is no table yet."""
    try:
        return _with_new_fields(spark, path, RAW)
    except FileNotFoundError:
        return RAW


def read_raw(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """The raw snapshot table. Without `merge_schema` only the known columns are read."""
    schema = _with_new_fields(spark, path, RAW) if merge_schema else RAW
    rows = _load(spark, path, "parquet", schema).select(*schema.fieldNames())
    return require_rows(rows, f"raw table {path}")


def _names(header: str) -> tuple[str, ...]:
    """Column names of a header line; unnamed and repeated ones are told apart by place."""
    found = next(csv.reader([header.removeprefix("\ufeff")]))
    names = [name or f"_c{i}" for i, name in enumerate(found)]
    return tuple(f"{n}{i}" if n in names[:i] else n for i, n in enumerate(names))


def csv_layouts(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, line_breaks) of CSV files, in one job, however many there are.

    The header is the first line that is not blank. A file may have line breaks in its fields if some line
    has an odd number of quotes.
    """
    lines = _load(spark, path, "text", None).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    return (
        lines.where("trim(value) <> ''")
        .groupBy("file")
        .agg(
            F.min_by("value", F.struct("start", "line")).alias("header"),
            F.bool_or(odd).alias("line_breaks"),
        )
    )


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Raw snapshots from CSV files, every column as text, with a landing order.

    Only the empty field is null; `NA` or `null` stay text. The landing order follows the file
    within one file. Files are grouped by their header and put together by column name. Files whose fields
    hold no line breaks are split over tasks; `multi_line` says for all files whether there are any.
    """
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    # A row per file.
    for row in csv_layouts(spark, path).orderBy("file").collect():
        breaks = row["line_breaks"] if multi_line is None else multi_line
        names = _names(row["header"])
        if row["line_breaks"] and row["header"].count('"') % 2:
            # The header itself goes over several lines.
            names = tuple(_load(spark, row["file"], "csv", None, **CSV).columns)
        groups.setdefault((names, breaks), []).append(row["file"])
    frames = []
    for (names, breaks), files in groups.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        options = {**CSV, "multiLine": str(breaks).lower(), "enforceSchema": "false"}
        frames.append(_load(spark, files, "csv", schema, **options))
    if not frames:
        raise ValueError(f"raw file {path} has no rows")
    rows = union_growing(*frames).withColumn("ingest_seq", F.monotonically_increasing_id())
    return require_rows(rows, f"raw file {path}")


def enriched_days(spark: SparkSession, path: str) -> list[str]:
    """The days of the enriched table, from its folders; no file is listed or opened."""
    return [d for d in values_of(spark, path, "snapshot_date") if not d.startswith("__")]


def read_enriched(
    spark: SparkSession, path: str, fmt: str = "parquet", days: list[str] | None = None
) -> DataFrame:
    """The enriched table, as Parquet or as a CSV export (same columns, typed on read).

    It is always written as a whole, so all files have the columns of any one. With `days`, only the
    folders of these are listed.
    """
    if fmt == "parquet":
        where = path if days is None else [f"{path}/snapshot_date={d}" for d in days]
        schema = _with_new_fields(spark, where, ENRICHED, merge=False, basePath=path)
        rows = _load(spark, where, fmt, schema, basePath=path)
        return require_rows(rows, f"enriched table {path}")
    header = _load(spark, path, fmt, None, **CSV).columns
    known = {field.name: field for field in ENRICHED.fields}
    fields = [known.get(name, T.StructField(name, T.StringType())) for name in header]
    rows = _load(spark, path, fmt, T.StructType(fields), **CSV)
    return require_rows(rows, f"enriched table {path}")


_HOURLY = (
    "snapshot_hour_utc int, snapshots bigint, unique_streamers bigint, total_viewers bigint, "
    "avg_viewers double, peak_viewers bigint"
)
_AUDIENCE = "snapshots bigint, avg_viewers double, peak_viewers bigint"

SUMMARY_SCHEMAS = {
    "top_games_summary": f"game_name string, {_AUDIENCE}, avg_stream_duration_hours double",
    "streamer_summary": (
        "user_id string, user_login string, user_name string, language string, "
        "primary_game string, snapshots bigint, first_seen_at timestamp, last_seen_at timestamp, "
        "avg_viewers double, peak_viewers bigint, avg_delta double, best_rank int, "
        "hours_observed double"
    ),
    "language_summary": f"language string, {_AUDIENCE}, avg_delta double",
    "language_hourly_summary": f"language string, {_HOURLY}",
    "game_hourly_summary": f"game_name string, {_HOURLY}",
    "hourly_summary": f"snapshot_hour_utc int, {_AUDIENCE}",
    "maturity_summary": f"is_mature boolean, {_AUDIENCE}, avg_delta double",
    "collection_health_summary": (
        "collected_at timestamp, rows_collected bigint, unique_streamers bigint, "
        "unique_games bigint, total_viewers bigint, min_viewers bigint, avg_viewers double, "
        "max_viewers bigint, avg_minutes_since_last_snapshot double"
    ),
    "fastest_growing_streams": (
        "collected_at timestamp, user_name string, game_name string, language string, "
        "viewer_count bigint, viewer_count_delta double, viewer_count_pct_change double, "
        "viewer_trend string"
    ),
}


def read_summary(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One stored summary table with typed columns."""
    schema = T.StructType.fromDDL(SUMMARY_SCHEMAS[name])
    return _load(spark, f"{directory}/{name}", "csv", schema, **CSV)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def reorder(df: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Known columns first in the given order, then all others."""
    first = [c for c in (wanted or RAW_COLUMNS) if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])
