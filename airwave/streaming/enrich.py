"""Incremental enrichment.

Rank needs the other rows of a batch, history the earlier rows of a stream. Each micro-batch
therefore looks up where its streams stand (`state`), and which batches were seen before (`times`):

* All rows newer than their stream's last one, in batches not seen before: history continues from
  the state; nothing written earlier is read or changes. This is the normal case.
* A row at or before its stream's last one (late, or a repeat): the stream's rows from that day on are worked
  out again, continuing from its last row before. A batch seen before: its ranks are worked out again. Only the
  days that hold such rows are listed and read, and new versions of these rows are written.

Folders under the output: `rows` (versions of enriched rows, by micro-batch and day), `merged` (the same, after
merges), `manifest` (which of these folders are live, see `streaming.manifest`), `state` (last time, last count, row
count and days per stream), `times` (batch times) and `changes` (the batch times that a micro-batch touched, for
streams that follow the table). `state` and `times` are logs cut into periods of `compact_every` micro-batches: the
first entry of a period is complete, so a lookup lists and reads one period, and older periods are removed.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airwave.functions.coerce import run_instant
from airwave.operators.dedupe import first_rows, union_growing
from airwave.operators.ordered import (
    SERIES,
    UNREAD,
    batch_ranks,
    dense_rank_in_batch,
    stream_history,
    with_series_key,
)
from airwave.plans.enrich import (
    TIME,
    add_changes,
    add_row_features,
    clean,
    history_keys,
    unique,
)
from airwave.schema import DERIVED
from airwave.sinks.files import make_folder, remove, values_of
from airwave.streaming.ingest import ONCE
from airwave.streaming.manifest import (
    DAY,
    FAN,
    KEPT,
    Folder,
    Manifest,
    due,
    read_folders,
    read_manifest,
    rows_of,
    write_manifest,
)

KEYS = [SERIES, TIME, UNREAD]
HISTORY = ["previous_viewer_count", "previous_collected_at", "stream_snapshot_number"]
RANK = "viewer_rank_in_snapshot"
#: Periods that `changes` reaches back; a stream that follows it must not rest longer.
CHANGE_PERIODS = 10
STATE = T.StructType(
    [
        T.StructField(SERIES, T.StringType()),
        T.StructField("_last_at", T.TimestampType()),
        T.StructField("_last_count", T.LongType()),
        T.StructField("_rows", T.IntegerType()),
        T.StructField("_days", T.ArrayType(T.DateType())),
        T.StructField("batch_id", T.LongType()),
    ]
)
TIMES = T.StructType(
    [T.StructField(TIME, T.TimestampType()), T.StructField("batch_id", T.LongType())]
)
CHANGES = TIMES


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _period(out: str, log: str, epoch: int, compact_every: int) -> str:
    return f"{out}/{log}/since={epoch // compact_every * compact_every}"


def _log_before(
    spark: SparkSession, out: str, log: str, epoch: int, compact_every: int, schema: T.StructType
) -> DataFrame | None:
    """Entries of a log that a micro-batch builds on."""
    entries = _stored(spark, _period(out, log, epoch - 1, compact_every), schema)
    return None if entries is None else entries.where(F.col("batch_id") < epoch)


def _log(entries: DataFrame, out: str, log: str, epoch: int, compact_every: int) -> None:
    period = _period(out, log, epoch, compact_every)
    entries.write.mode("overwrite").parquet(f"{period}/batch_id={epoch}")
    if epoch % compact_every == 0:
        # The period before stays, for this micro-batch when it runs again.
        spark = entries.sparkSession
        for since in values_of(spark, f"{out}/{log}", "since"):
            if int(since) < epoch - compact_every:
                remove(spark, f"{out}/{log}/since={since}")


def _with_unread(rows: DataFrame) -> DataFrame:
    """Stored rows; those of earlier versions of this code lack the text of unreadable times."""
    known = F.col(UNREAD) if UNREAD in rows.columns else F.lit(None).cast("string")
    return rows.withColumn(UNREAD, F.coalesce(known, F.lit("")))


def _newest_version(rows: DataFrame) -> DataFrame:
    keyed = with_series_key(_with_unread(rows))
    return first_rows(keyed, KEYS, [F.col("batch_id").desc()]).drop(SERIES)


def read_incremental(
    spark: SparkSession, out: str, days: list[date] | None = None
) -> DataFrame:
    """The enriched table as of now: the newest version of every row, of the given days or of all.

    Only the live folders of these days are listed, and no footer is read for the columns.
    """
    manifest = read_manifest(spark, out)
    if manifest is None or not manifest.folders:
        raise FileNotFoundError(f"no enriched rows under {out}")
    rows = rows_of(spark, out, manifest, days)
    if rows is None:
        return spark.createDataFrame([], manifest.columns).drop(UNREAD)
    return _newest_version(rows).drop("batch_id", DAY, UNREAD)


def changes_stream(spark: SparkSession, out: str) -> DataFrame:
    """The batch times that micro-batches touched, as a stream, for what follows the table."""
    make_folder(spark, f"{out}/changes")
    return spark.readStream.schema(CHANGES).parquet(f"{out}/changes")


def _latest_state(states: DataFrame) -> DataFrame:
    """Where each stream stands. Entries only move forward in time, then in number of rows."""
    order = [F.col(c).desc() for c in ("_last_at", "_rows", "batch_id")]
    return first_rows(states, [SERIES], order).drop("batch_id")


def _finish(rows: DataFrame, columns: list[str]) -> DataFrame:
    full = add_changes(add_row_features(rows)).drop(SERIES)
    return full.select(*columns, *DERIVED.fieldNames())


def continue_history(
    keys: DataFrame, state: DataFrame, shared: list | None = None
) -> DataFrame:
    """History of new rows whose streams already have a past."""
    first = F.col("stream_snapshot_number") == 1
    known = state.select(SERIES, "_last_at", "_last_count", "_rows")
    return (
        stream_history(keys, shared)
        .join(known, SERIES, "left")
        .withColumns(
            {
                "previous_viewer_count": F.when(first, F.col("_last_count")).otherwise(
                    F.col("previous_viewer_count")
                ),
                "previous_collected_at": F.when(first, F.col("_last_at")).otherwise(
                    F.col("previous_collected_at")
                ),
                "stream_snapshot_number": F.col("stream_snapshot_number")
                + F.coalesce("_rows", F.lit(0)),
            }
        )
        .drop("_last_at", "_last_count", "_rows")
    )


def _appended(fresh: DataFrame, keys: DataFrame, state: DataFrame, shared: list) -> DataFrame:
    side = dense_rank_in_batch(continue_history(keys, state, shared), keys).drop("viewer_count")
    return unique(fresh).join(side, KEYS)


def _stands(rows: DataFrame, *more) -> DataFrame:
    """Last time, last count and number of rows per stream, from rows with their history."""
    return rows.groupBy(SERIES).agg(
        F.max(TIME).alias("_last_at"),
        F.max_by("viewer_count", "stream_snapshot_number").alias("_last_count"),
        F.max("stream_snapshot_number").alias("_rows"),
        *more,
    )


def _late(keys: DataFrame, state: DataFrame) -> DataFrame:
    """Streams with rows at or before their last one: the day of the first such row, and their days."""
    return (
        keys.join(state, SERIES)
        .where(F.col(TIME) <= F.col("_last_at"))
        .groupBy(SERIES)
        .agg(F.to_date(F.min(TIME)).alias("_from"), F.any_value("_days").alias("_days"))
    )


def _touched_days(late: DataFrame, again: DataFrame) -> list[date] | None:
    """The days that hold rows of late streams since, their last day before, and the batches seen before.

    One value per day; null, for all days, where the state comes from a version that did not keep days.
    """
    since = F.filter("_days", lambda d: d >= F.col("_from"))
    before = F.array_max(F.filter("_days", lambda d: d < F.col("_from")))
    days = late.select(F.explode_outer(F.concat(since, F.array(before))).alias("d"), "_days")
    found = days.select("d", F.col("_days").isNull().alias("unknown")).distinct().collect()
    if any(r["unknown"] for r in found):
        return None
    batches = again.select(F.to_date(TIME).alias("d")).distinct().collect()
    return sorted({r["d"] for r in (*found, *batches) if r["d"] is not None})


def _reworked(
    fresh: DataFrame, past: DataFrame, late: DataFrame, state: DataFrame, shared: list
) -> DataFrame:
    """New versions of the rows of late streams, from their day on, and of the micro-batch's batches.

    `past` holds all versions written so far in the touched days. What is touched is picked by key before
    versions are compared; versions of a row share both keys, so picking by either keeps them together.
    Rows of other streams in a batch seen before keep their history; rows of late streams in other
    batches keep their rank.
    """
    times = fresh.select(TIME).distinct().withColumn("_again", F.lit(True))
    hit = (
        with_series_key(past)
        .join(late.select(SERIES, "_from"), SERIES, "left")
        .join(times, TIME, "left")
        .where(F.col("_from").isNotNull() | F.col("_again"))
    )
    newest = first_rows(hit, KEYS, [F.col("batch_id").desc()]).drop("batch_id", DAY)
    is_open = F.coalesce(F.to_date(TIME) >= F.col("_from"), F.lit(False))
    carried = _stands(newest.where(F.col("_from").isNotNull() & ~is_open))
    others = state.join(late, SERIES, "left_anti").select(*carried.columns)
    narrow = [c for c in ("id", TIME, UNREAD, "ingest_seq", "viewer_count") if c in past.columns]

    def with_fresh(rows: DataFrame) -> DataFrame:
        return history_keys(rows.select(*narrow).unionByName(fresh.select(*narrow)))

    history = continue_history(
        with_fresh(newest.where(is_open)), others.unionByName(carried), shared
    ).drop("viewer_count")
    ranks = batch_ranks(with_fresh(newest.where(F.col("_again"))))
    # A fresh row has no earlier history and rank.
    kept = newest.where(is_open | F.col("_again")).drop("_from", "_again", SERIES)
    kept = kept.drop(*[c for c in DERIVED.fieldNames() if c not in (*HISTORY, RANK)])
    kept = kept.withColumnsRenamed({c: f"_old_{c}" for c in (*HISTORY, RANK)})
    rows = (
        unique(union_growing(kept, fresh))
        .join(history, KEYS, "left")
        .join(ranks, [TIME, "viewer_count"], "left")
    )
    is_new = F.col("stream_snapshot_number").isNotNull()
    settled = {c: F.when(is_new, F.col(c)).otherwise(F.col(f"_old_{c}")) for c in HISTORY}
    settled[RANK] = F.coalesce(RANK, f"_old_{RANK}")
    return rows.withColumns(settled).drop(*[f"_old_{c}" for c in (*HISTORY, RANK)])


def _shared_instants(past: DataFrame | None, run_ts: datetime | str) -> list:
    """Times that runs gave to rows whose own cannot be read: one per run, at most."""
    found = [run_instant(run_ts)]
    if past is not None:
        unread = past.where(F.col(UNREAD) != "").select(TIME).distinct()
        found += [F.lit(r[TIME]) for r in unread.collect()]
    return found


def _merge(
    spark: SparkSession, out: str, manifest: Manifest, fan: int
) -> Manifest:
    """The manifest after the merges that are due; all days' in one job."""
    merges = due(manifest.folders, fan)
    if not merges:
        return manifest
    old = [folder for folders in merges.values() for folder in folders]
    target = f"merged/batch_id={manifest.epoch}"
    rows = _newest_version(read_folders(spark, out, old, manifest.columns)).drop("batch_id")
    laid_out = rows.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY)
    laid_out.parquet(f"{out}/{target}")
    new = [
        Folder(day, manifest.epoch, max(f.level for f in folders) + 1, f"{target}/{DAY}={day}")
        for day, folders in merges.items()
    ]
    live = {*manifest.folders}.difference(old).union(new)
    replaced = tuple(folder.path for folder in old)
    return Manifest(manifest.epoch, tuple(sorted(live)), manifest.columns, replaced)


def enrich_batch(
    batch: DataFrame,
    epoch: int,
    out: str,
    run_ts: datetime | str | None = None,
    compact_every: int = 144,
    fan: int = FAN,
    kept: int = KEPT,
) -> None:
    """Process one micro-batch of raw rows. Running it again for the same number replaces it."""
    spark = batch.sparkSession
    run_ts = run_ts or datetime.now(timezone.utc)
    compacts = epoch % compact_every == 0
    before = read_manifest(spark, out, epoch)
    if before is None:
        # From now on, only what a manifest names is part of the table.
        before = Manifest(min(epoch, 0) - 1, (), T.StructType([]))
        write_manifest(spark, out, before)
    states = _log_before(spark, out, "state", epoch, compact_every, STATE)
    times = _log_before(spark, out, "times", epoch, compact_every, TIMES)
    if states is None or times is None:
        state = spark.createDataFrame([], STATE).drop("batch_id")
        known = spark.createDataFrame([], TIMES).drop("batch_id")
    else:
        state, known = _latest_state(states), times.select(TIME).distinct()
    fresh = clean(batch.drop("batch_id"), run_ts).persist()
    try:
        if fresh.isEmpty():
            if compacts and states is not None:
                _log(state, out, "state", epoch, compact_every)
                _log(known, out, "times", epoch, compact_every)
            return
        keys = history_keys(fresh)
        late = _late(keys, state)
        again = keys.join(known, TIME, "left_semi")
        past = None
        if states is not None and not (late.isEmpty() and again.isEmpty()):
            past = rows_of(spark, out, before, _touched_days(late, again))
        if past is not None:
            past = _with_unread(past)
            given = [c for c in past.columns if c not in (*DERIVED.fieldNames(), "batch_id", DAY)]
            columns = given + [c for c in fresh.columns if c not in given]
            rows = _reworked(fresh, past, late, state, _shared_instants(past, run_ts))
        else:
            columns = fresh.columns
            rows = _appended(fresh, keys, state, _shared_instants(None, run_ts))
        target = f"rows/batch_id={epoch}"
        finished = _finish(rows, columns).withColumn(DAY, F.to_date(TIME))
        # Few files a day, however many tasks there are.
        laid_out = finished.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY)
        laid_out.parquet(f"{out}/{target}")
        fields = [f for f in finished.schema if f.name not in (DAY, *before.columns.fieldNames())]
        own = [
            Folder(day, epoch, 0, f"{target}/{DAY}={day}")
            for day in values_of(spark, f"{out}/{target}", DAY)
        ]
        now = Manifest(
            epoch, (*before.folders, *own), T.StructType([*before.columns.fields, *fields])
        )
        # What follows reads the rows just written, not the plan that made them.
        written = with_series_key(read_folders(spark, out, own, now.columns))
        delta = _stands(written, F.collect_set(DAY).alias("_more"))
        old_days = state.select(SERIES, F.col("_days").alias("_old"), F.lit(True).alias("_known"))
        all_days = F.array_union(F.coalesce("_old", F.expr("cast(array() AS array<date>)")), "_more")
        # Days of a stream are unknown for good once they were not kept.
        settled = F.when(F.col("_known") & F.col("_old").isNull(), None).otherwise(all_days)
        delta = (
            delta.join(old_days, SERIES, "left")
            .withColumn("_days", settled)
            .drop("_more", "_old", "_known")
        )
        if compacts:
            merged = union_growing(
                state.withColumn("batch_id", F.lit(epoch - 1)),
                delta.withColumn("batch_id", F.lit(epoch)),
            )
            delta = _latest_state(merged)
        seen = keys.select(TIME).distinct()
        if compacts:
            seen = seen.union(known).distinct()
        _log(delta, out, "state", epoch, compact_every)
        _log(seen, out, "times", epoch, compact_every)
        write_manifest(spark, out, _merge(spark, out, now, fan), kept)
        touched = written.select(TIME).distinct()
        touched.coalesce(1).write.mode("overwrite").parquet(f"{out}/changes/batch_id={epoch}")
        if compacts:
            for number in values_of(spark, f"{out}/changes", "batch_id"):
                if int(number) < epoch - CHANGE_PERIODS * compact_every:
                    remove(spark, f"{out}/changes/batch_id={number}")
    finally:
        fresh.unpersist()


def enrich_stream(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    run_ts: datetime | str | None = None,
    compact_every: int = 144,
    trigger: dict | None = None,
    fan: int = FAN,
) -> StreamingQuery:
    """Keep the enriched rows under `out` up to date with a stream of raw rows."""

    def process(batch: DataFrame, epoch: int) -> None:
        enrich_batch(batch, epoch, out, run_ts, compact_every, fan)

    return (
        raw.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .start()
    )
