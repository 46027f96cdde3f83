"""The fact table: Parquet, partitioned by day, sorted by (collected_at, id) inside files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from airwave.operators.joins import batches_not_in
from airwave.schema import FACT
from airwave.session import scratch, stored

DEFAULT_TABLE = "stream_snapshots_enriched"


def ensure_table(spark: SparkSession, table: str = DEFAULT_TABLE, database: str | None = None) -> str:
    """Create database and table where they are absent; returns the qualified name."""
    name = f"{database}.{table}" if database else table
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACT.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, collected_date DATE) "
        "USING parquet PARTITIONED BY (collected_date)"
    )
    return name


def commits_of(name: str) -> str:
    return f"{name}_commits"


def committed(spark: SparkSession, name: str) -> DataFrame:
    """(collected_at, rows, checksum) of the batches that were loaded to their end."""
    columns = "collected_at TIMESTAMP_NTZ, rows BIGINT, checksum DECIMAL(38, 0)"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {commits_of(name)} ({columns}) USING parquet")
    return spark.table(commits_of(name))


def batch_sums(fact: DataFrame) -> DataFrame:
    """Rows and checksum per batch; equal for the same rows in any order."""
    known = F.xxhash64(*[f.name for f in FACT.fields]).cast("decimal(38, 0)")
    return fact.groupBy("collected_at").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(known).cast("decimal(38, 0)").alias("checksum")
    )


def held_rows(spark: SparkSession, name: str, first: date, last: date) -> DataFrame:
    """Fact rows of a span of days, which limits the scan."""
    rows = spark.table(name).where(F.col("collected_date").between(first, last))
    return rows.select(*FACT.fieldNames())


def _laid_out(fact: DataFrame) -> DataFrame:
    # insertInto goes by position.
    rows = fact.select(*FACT.fieldNames(), F.to_date("collected_at").alias("collected_date"))
    return rows.hint("rebalance", "collected_date").sortWithinPartitions(
        "collected_date", "collected_at", "id"
    )


def replace_days(fact: DataFrame, name: str) -> None:
    """Put these rows in place of all that the table holds for their days; other days stay."""
    settings = fact.sparkSession.conf
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = settings.get(mode)
    settings.set(mode, "dynamic")
    try:
        _laid_out(fact).write.insertInto(name, overwrite=True)
    finally:
        settings.set(mode, before)


def insert_batch(fact: DataFrame, name: str) -> int:
    """Append fact rows and return their number.

    Rebalancing by day gives files of even size: AQE splits a day with many rows and merges small
    ones. The count is taken while writing.
    """
    # An empty input is optimised away, and its count with it.
    if fact.isEmpty():
        return 0
    counted = Observation()
    observed = fact.observe(counted, F.count(F.lit(1)).alias("rows"))
    _laid_out(observed).write.insertInto(name)
    return counted.get["rows"]


def load_batches(spark: SparkSession, fact: DataFrame, name: str) -> tuple[int, bool]:
    """Load the batches of `fact` that are not committed; their rows, and whether any was replaced.

    A batch is committed, with its number of rows and a checksum, after its rows are written. Rows of a batch
    without a commit come from a load that stopped, or from before there were commits: if they are all there
    the batch is committed as it is, otherwise its rows are replaced. One writer at a time is assumed.
    """
    known = committed(spark, name)
    missing = batches_not_in(fact, known)
    with scratch(spark) as folder:
        sums = stored(batch_sums(missing), folder)
        day = F.to_date("collected_at")
        span = sums.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
        if span["first"] is None:
            return 0, False
        held = held_rows(spark, name, span["first"], span["last"])
        held = held.join(sums.select("collected_at"), "collected_at", "left_semi")
        there = stored(batch_sums(held), folder)
        whole = there.join(sums, ["collected_at", "rows", "checksum"], "left_semi")
        broken = stored(there.join(whole, "collected_at", "left_anti").select("collected_at"), folder)
        wanted = batches_not_in(missing, whole)
        # One value per day with a broken batch.
        days = [r[0] for r in broken.select(day).distinct().collect()]
        if days:
            fixed = spark.table(name).where(F.col("collected_date").isin(days))
            others = batches_not_in(fixed.select(*FACT.fieldNames()), broken)
            again = wanted.where(day.isin(days))
            replace_days(stored(others.unionByName(again), folder), name)
            spark.catalog.refreshTable(name)
            rows = again.count() + insert_batch(wanted.where(~day.isin(days)), name)
        else:
            rows = insert_batch(wanted, name)
        done = sums.select(*known.columns).coalesce(1)
        done.write.insertInto(commits_of(name))
        return rows, bool(days)
