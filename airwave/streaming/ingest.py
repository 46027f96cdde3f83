"""Landed pages to the raw table, and the raw table as a stream.

The pages of a run may land over several triggers. They wait in a table (`<raw>.pending`) until the run is complete:
its first final page and all pages before it are there, or as many pages as are read at most. A run that stays
incomplete is taken as it is once a run is there that is later by more than the waiting time. The ends of the
runs taken lately are kept (`<raw>.runs`), so that what lands after them is cut as if it had come in time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airwave.schema import PAYLOAD_STREAM, payload
from airwave.sinks.files import exists, remove, values_of
from airwave.sources.payload import (
    PAGE_OPTIONS,
    is_final,
    pages_in_run,
    raw_projection,
    run_ends,
    run_stamp,
    stream_rows,
)
from airwave.sources.snapshots import raw_schema

ONCE = {"availableNow": True}
#: How much later than an incomplete run another must be for it to be taken as it is.
WAIT = "30 minutes"
#: How long the ends of runs are kept.
REMEMBERED = "7 days"
#: Number of a run's first page.
FIRST_PAGE = 1
ENDS = "_run string, _cut int"


def _waiting(raw: str, epoch: int) -> str:
    return f"{raw.rstrip('/')}.pending/batch_id={epoch}"


def _ended(raw: str, epoch: int) -> str:
    return f"{raw.rstrip('/')}.runs/batch_id={epoch}"


def _before(spark: SparkSession, raw: str, epoch: int, log: str) -> str | None:
    """The newest finished state that a micro-batch builds on."""
    folder = f"{raw.rstrip('/')}.{log}"
    numbers = sorted((int(n) for n in values_of(spark, folder, "batch_id")), reverse=True)
    paths = (f"{folder}/batch_id={n}" for n in numbers if n < epoch)
    return next((p for p in paths if exists(spark, f"{p}/_SUCCESS")), None)


def _forget(spark: SparkSession, raw: str, epoch: int) -> None:
    """Remove the states of all but the last two micro-batches."""
    for log in ("pending", "runs"):
        folder = f"{raw.rstrip('/')}.{log}"
        for n in sorted(map(int, values_of(spark, folder, "batch_id")))[:-2]:
            if n < epoch:
                remove(spark, f"{folder}/batch_id={n}")


def complete_runs(
    pages: DataFrame, known: DataFrame, wait: str = WAIT, max_pages: int | None = None
) -> DataFrame:
    """(run_ts) of the runs that need not wait any longer; `known` has the ends of runs taken before."""
    ends = run_ends(pages)
    last = F.least("_cut", F.lit(max_pages).cast("int"))
    needed = F.col("page_no").between(FIRST_PAGE, F.col("_last"))
    runs = (
        pages.join(ends.withColumn("_last", last), F.col("run_ts") == F.col("_run"))
        .groupBy("run_ts", "_last")
        .agg(F.count_distinct(F.when(needed, F.col("page_no"))).alias("_pages"))
    )
    both = pages.select("run_ts").unionByName(known.select(F.col("_run").alias("run_ts")))
    newest = both.agg(F.max(run_stamp()).alias("newest")).scalar()
    late = run_stamp() < newest - F.expr(f"INTERVAL {wait}")
    whole = F.col("_pages") == F.col("_last") - FIRST_PAGE + 1
    taken = runs.join(known.select(F.col("_run").alias("run_ts")).distinct(), "run_ts", "left_semi")
    # A time that cannot be read cannot be waited for.
    done = F.coalesce(whole, F.lit(False)) | F.coalesce(late, F.lit(True))
    return runs.where(done).select("run_ts").unionByName(taken.select("run_ts")).distinct()


def take_runs(
    batch: DataFrame,
    epoch: int,
    raw: str,
    max_pages: int | None = None,
    wait: str | None = WAIT,
) -> None:
    """Process one micro-batch of pages. Running it again for the same number replaces it."""
    spark = batch.sparkSession
    target = f"{raw}/batch_id={epoch}"
    if wait is None:
        raw_projection(stream_rows(pages_in_run(batch, max_pages))).write.mode("overwrite").parquet(target)
        return
    pages = batch
    if path := _before(spark, raw, epoch, "pending"):
        pages = spark.read.schema(batch.schema).parquet(path).unionByName(batch)
    known = spark.createDataFrame([], ENDS)
    if path := _before(spark, raw, epoch, "runs"):
        known = spark.read.schema(ENDS).parquet(path)
    pages = pages.persist()
    try:
        done = complete_runs(pages, known, wait, max_pages).withColumn("_done", F.lit(True))
        marked = pages.join(done, "run_ts", "left")
        taken = F.col("run_ts").isNull() | F.coalesce("_done", F.lit(False))
        now = marked.where(taken).drop("_done").select(*batch.columns)
        rows = raw_projection(stream_rows(pages_in_run(now, max_pages, known)))
        rows.write.mode("overwrite").parquet(target)
        ends = run_ends(now, known)
        newest = ends.agg(F.max(_time("_run")).alias("newest")).scalar()
        recent = _time("_run") >= newest - F.expr(f"INTERVAL {REMEMBERED}")
        kept = ends.where(recent).coalesce(1)
        kept.write.mode("overwrite").parquet(_ended(raw, epoch))
        waiting = marked.where(~taken).drop("_done").select(*batch.columns)
        waiting.coalesce(1).write.mode("overwrite").parquet(_waiting(raw, epoch))
        _forget(spark, raw, epoch)
    finally:
        pages.unpersist()


def _time(name: str) -> Column:
    return F.try_to_timestamp(F.col(name))


def ingest_stream(
    spark: SparkSession,
    landing: str,
    raw: str,
    checkpoint: str,
    max_pages: int | None = None,
    stream: T.StructType = PAYLOAD_STREAM,
    trigger: dict | None = None,
    wait: str | None = WAIT,
) -> StreamingQuery:
    """Append newly landed runs to the raw table, each once it is complete.

    With `wait=None` a run ends where its pages in one micro-batch end; all of them must then land before
    a trigger sees them, for example by moving the run's folder into place.
    """
    pages = spark.readStream.schema(payload(stream)).options(**PAGE_OPTIONS).json(landing)

    def append(batch: DataFrame, epoch: int) -> None:
        take_runs(batch, epoch, raw, max_pages, wait)

    return (
        pages.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .start()
    )


def raw_stream(spark: SparkSession, raw: str) -> DataFrame:
    """New rows of the raw table, as text, with the new fields that it holds when the stream starts."""
    batch = T.StructField("batch_id", T.LongType())
    schema = T.StructType([*raw_schema(spark, raw).fields, batch])
    return spark.readStream.schema(schema).parquet(raw)
