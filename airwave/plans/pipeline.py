"""Jobs: each reads one stored table and writes the next."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airwave.plans.enrich import enrich
from airwave.plans.fact import load_latest_batch
from airwave.plans.summaries import build_summaries, measures, pre_aggregate, prepare
from airwave.schema import PAYLOAD_STREAM
from airwave.session import configure, scratch, stored
from airwave.sinks.fact import DEFAULT_TABLE
from airwave.sinks.files import exists
from airwave.sinks.ledger import note_pages, read_ledger, settle
from airwave.sinks.tables import append_raw, new_number, write_enriched, write_summaries
from airwave.sources.payload import (
    is_final,
    landed_files,
    pages_in_run,
    read_pages,
    stream_rows,
)
from airwave.sources.snapshots import enriched_days, read_enriched, read_raw
from airwave.streaming.enrich import changes_stream, enrich_stream
from airwave.streaming.health import health_stream
from airwave.streaming.ingest import WAIT, ingest_stream, raw_stream
from airwave.streaming.load import load_stream
from airwave.streaming.summaries import read_summaries, summaries_stream

#: New files that are named one by one; beyond, the landing folder is read and the new ones are picked.
MANY_FILES = 10_000
#: What tells a landed row from all others.
ROW = ["collected_at", "ingest_seq", "id", "viewer_count"]


@dataclass(frozen=True)
class Paths:
    """Where a pipeline keeps its tables, on storage that every executor reaches."""

    landing: str
    raw: str
    enriched: str
    summaries: str

    @classmethod
    def under(cls, root: str) -> Paths:
        return cls(f"{root}/landing", f"{root}/raw", f"{root}/enriched", f"{root}/summaries")


def ingest_job(
    spark: SparkSession,
    landing: str,
    raw: str,
    max_pages: int | None = None,
    on_empty: str = "error",
    stream: T.StructType = PAYLOAD_STREAM,
) -> int:
    """Append the rows of pages that landed since; a wider `stream` keeps new fields.

    A ledger (`sinks.ledger`) knows the files that were taken in, and where their runs ended, so the cost
    follows the new files: those of older runs are listed, not read, and neither are raw rows. Pages that may
    repeat known rows are the exception: a known page of a run under another name or with another length, a
    page without a run, and all pages as long as the ledger is younger than the table. Their rows are compared
    with the raw rows of their span of time, by run time, landing order, id and count.
    """
    noted = read_ledger(spark, raw)
    files = landed_files(spark, landing)
    if noted is not None:
        known = noted.select("file", "length")
        files = files.join(known, ["file", "length"], "left_anti")
    names = [r["file"] for r in files.select("file").take(MANY_FILES + 1)]
    if not names and noted is not None:
        return 0
    if len(names) <= MANY_FILES:
        pages = read_pages(spark, names or landing, stream)
    else:
        pages = read_pages(spark, landing, stream)
    pages = pages.select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length")
    )
    if len(names) > MANY_FILES:
        pages = pages.join(files, ["file", "length"], "left_semi")
    ends = None
    again = F.col("run_ts").isNull()
    if noted is not None:
        runs = pages.select("run_ts").distinct()
        seen = noted.join(runs, "run_ts", "left_semi")
        ends = seen.where("final").select(F.col("run_ts").alias("_run"), F.col("page_no").alias("_cut"))
        page = seen.select("run_ts", "page_no", F.lit(True).alias("_seen")).distinct()
        pages = pages.join(page, ["run_ts", "page_no"], "left")
        again = again | F.col("_seen")
    elif exists(spark, raw):
        again = F.lit(True)
    again = F.coalesce(again, F.lit(False))
    # The run's end is judged over all new pages.
    kept = pages_in_run(pages, max_pages, ends)
    rows = stream_rows(kept.where(~again))
    if not pages.where(again).isEmpty():
        repeated = stream_rows(kept.where(again))
        rows = rows.unionByName(_unknown_rows(spark, repeated, raw))
    number = new_number()
    notes = pages.withColumn("final", is_final())
    if rows.isEmpty():
        # Nothing that could be written; these pages are done with, unless there was no page at all.
        landed = not pages.isEmpty() and not stream_rows(kept).isEmpty()
        if not landed:
            return append_raw(rows, raw, on_empty)
        note_pages(notes, raw, number, settled=True)
        return 0
    note_pages(notes, raw, number)
    written = append_raw(rows, raw, on_empty, number)
    settle(spark, raw, new_number())
    return written


def _unknown_rows(spark: SparkSession, rows: DataFrame, raw: str) -> DataFrame:
    """The rows that the raw table does not hold. Its files keep the span of times of each block."""
    try:
        known = read_raw(spark, raw).select(*ROW)
    except FileNotFoundError:
        return rows
    span = rows.agg(F.min("collected_at").alias("a"), F.max("collected_at").alias("b")).first()
    inside = F.col("collected_at").between(span["a"], span["b"]) | F.col("collected_at").isNull()
    known = known.where(inside).withColumnsRenamed({c: f"_{c}" for c in ROW})
    same = [F.col(c).cast("string").eqNullSafe(F.col(f"_{c}").cast("string")) for c in ROW]
    return rows.join(known, same, "left_anti")


def enrich_job(
    spark: SparkSession, raw: str, enriched: str, run_ts: datetime | str | None = None
) -> str:
    """Recompute the enriched table from the whole raw table."""
    return write_enriched(enrich(read_raw(spark, raw, merge_schema=True), run_ts), enriched)


def summaries_job(spark: SparkSession, enriched: str, directory: str) -> list[str]:
    """Write the nine summaries.

    Seven of them are built from a stored pre-aggregate, so the enriched table is read three times,
    not nine, and a lost executor does not send them back to it.
    """
    table = read_enriched(spark, enriched)
    with scratch(spark) as folder:
        folded = stored(pre_aggregate(measures(prepare(table))), folder)
        return write_summaries(build_summaries(table, folded), directory)


def load_latest_batch_job(
    spark: SparkSession,
    enriched: str,
    table: str = DEFAULT_TABLE,
    database: str | None = None,
    mode: str = "latest",
) -> dict[str, Any]:
    """Load the newest batch of the enriched table, whose day comes from the table's folders.

    Files of other days are neither listed nor opened, but for `mode="all_missing"`.
    """
    newest = enriched_days(spark, enriched)[-1:]
    rows = read_enriched(spark, enriched, days=newest if newest and mode == "latest" else None)
    return load_latest_batch(spark, rows, table, database, mode, *newest)


def run_pipeline(
    spark: SparkSession,
    paths: Paths,
    run_ts: datetime | str | None = None,
    table: str = DEFAULT_TABLE,
    database: str | None = None,
    max_pages: int | None = None,
    stream: T.StructType = PAYLOAD_STREAM,
) -> dict[str, Any]:
    """Ingest, enrich, summarise, load. Schedule it with whatever runs jobs.

    The enriched table is recomputed from the whole raw table; `streaming.enrich` is the incremental way.
    """
    configure(spark)
    rows = ingest_job(spark, paths.landing, paths.raw, max_pages, stream=stream)
    enrich_job(spark, paths.raw, paths.enriched, run_ts)
    outputs = summaries_job(spark, paths.enriched, paths.summaries)
    loaded = load_latest_batch_job(spark, paths.enriched, table, database)
    return {"ingested": rows, "summaries": outputs, "loaded": loaded}


def follow_pipeline(
    spark: SparkSession,
    paths: Paths,
    run_ts: datetime | str | None = None,
    table: str = DEFAULT_TABLE,
    database: str | None = None,
    max_pages: int | None = None,
    stream: T.StructType = PAYLOAD_STREAM,
    wait: str | None = WAIT,
) -> list[str]:
    """Take in what landed since, and bring enriched rows, fact table, health and summaries up to date.

    The incremental counterpart of `run_pipeline`, for the same schedule: its cost follows the new runs and
    the days they touch. Each step is a stream that runs until it has caught up and goes on from its
    checkpoint, so a stopped job is repeated from where it was. Tables and checkpoints lie beside the
    enriched table (`<enriched>.incremental`). Returns the paths of the nine summaries.
    """
    configure(spark)
    out = f"{paths.enriched.rstrip('/')}.incremental"
    raw, partials = f"{out}/raw", f"{out}/partials"

    def caught_up(name: str, start: Callable[..., StreamingQuery], *given: Any, **more: Any) -> None:
        query = start(*given, checkpoint=f"{out}/checkpoints/{name}", **more)
        query.awaitTermination()

    caught_up("ingest", ingest_stream, spark, paths.landing, raw,
              max_pages=max_pages, stream=stream, wait=wait)
    caught_up("enrich", enrich_stream, raw_stream(spark, raw), f"{out}/table", run_ts=run_ts)
    followers = {
        "load": (load_stream, table, {"database": database}),
        "health": (health_stream, f"{out}/health", {}),
        "summaries": (summaries_stream, partials, {}),
    }
    for name, (start, target, more) in followers.items():
        changes = changes_stream(spark, f"{out}/table")
        caught_up(name, start, changes, f"{out}/table", target, **more)
    if not exists(spark, partials):
        return []
    return write_summaries(read_summaries(spark, partials), paths.summaries)
