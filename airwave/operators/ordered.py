"""Ordered computations split into slices, so that no group has to fit one task.

A plain window puts a whole group on one task. Here a group is cut into slices along its order (a
day of a stream's history, a range of the landing order inside one instant, 2^20 neighbouring values of
a measure). The window runs inside slices; a
table with one row per slice carries totals from each slice to the next. The result is the same as
with the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 2^20 neighbouring values per slice: a slice holds at most 2^20 distinct values, and values below
# 2^40 (a trillion viewers) make at most 2^20 slices.
SLICE_BITS = 20

SERIES = "_series"
# Rows of one instant are cut where their landing order reaches a multiple of 2^12.
LANDING_BITS = 12

# Tells rows apart whose collection time could not be read; empty where it could.
UNREAD = "_unread"
TIES = ("ingest_seq", "viewer_count", UNREAD)


def with_series_key(df: DataFrame, column: str = "id") -> DataFrame:
    """Add a non-null text key for `column`, so that null ids join and group as one series."""
    return df.withColumn(SERIES, F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("")))


def running_total(
    values: DataFrame,
    group: list[str],
    value: str,
    weight: str,
    descending: bool = False,
) -> DataFrame:
    """Add `running`: the sum of `weight` over this and all earlier values of the group.

    `values` has one row per distinct (group, value), none of them null.
    """
    def direction(name: str):
        return F.col(name).desc() if descending else F.col(name).asc()

    keys = [*group, "_slice"]
    sliced = values.withColumn("_slice", F.shiftright(F.col(value), SLICE_BITS)).repartition(*keys)
    inside = Window.partitionBy(*keys).orderBy(direction(value)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    between = Window.partitionBy(*group).orderBy(direction("_slice")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    if not group:
        between = Window.partitionBy(F.lit(0)).orderBy(direction("_slice")).rowsBetween(
            Window.unboundedPreceding, -1
        )
    carried = (
        sliced.groupBy(*keys)
        .agg(F.sum(weight).alias("_total"))
        .select(*keys, F.coalesce(F.sum("_total").over(between), F.lit(0)).alias("_before"))
    )
    return (
        sliced.withColumn("_inside", F.sum(weight).over(inside))
        .join(carried, keys)
        .withColumn("running", F.col("_inside") + F.col("_before"))
        .drop("_slice", "_inside", "_before")
    )


def batch_ranks(
    keys: DataFrame,
    batch: str = "collected_at",
    value: str = "viewer_count",
    rank: str = "viewer_rank_in_snapshot",
) -> DataFrame:
    """One row per distinct (batch, value) with the value's dense rank, highest first."""
    values = keys.select(batch, value).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    ranks = running_total(values, [batch], value, "_one", descending=True)
    return ranks.select(batch, value, F.col("running").cast("int").alias(rank))


def dense_rank_in_batch(rows: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Dense rank of the viewer count inside each batch.

    Rows of a batch are never gathered: the rank is a running count over the batch's distinct
    counts (taken from `keys`, by default `rows`), which combine before the shuffle. They are joined
    back by value, and AQE splits a (batch, count) pair that many rows share.
    """
    return rows.join(batch_ranks(rows if keys is None else keys), ["collected_at", "viewer_count"])


def slice_tails(keys: DataFrame, group: list[str]) -> DataFrame:
    """Last value, last time and row count per group of rows numbered by `_nth`."""
    return keys.groupBy(*group).agg(
        F.max("collected_at").alias("_last_at"),
        F.max_by("viewer_count", "_nth").alias("_last_count"),
        F.count(F.lit(1)).alias("_rows"),
    )


def _part_of_day(shared: list[Column]) -> Column:
    """Place of a row among the shared instants: odd at one of them, even between two."""
    time = F.col("collected_at")
    if len(shared) == 1:
        return F.when(time > shared[0], 2).when(time == shared[0], 1).otherwise(0)
    instants = F.array(*shared)
    before = F.size(F.filter(instants, lambda instant: instant < time))
    return before * 2 + F.array_contains(instants, time).cast("int")


def in_slices(keys: DataFrame, shared: list[Column] | None = None) -> tuple[DataFrame, list[str]]:
    """Add the columns that cut a series, in its order, into slices; and the columns' names.

    A slice is a day. An instant that many rows of a series may share (`shared`: the times of runs, given to
    rows whose own time cannot be read) cuts its day, and is itself cut into ranges of the landing order.
    A table without landing numbers is cut by day and instant only.
    """
    sliced = keys.withColumn("_day", F.to_date("collected_at"))
    if not shared:
        return sliced, ["_day"]
    sliced = sliced.withColumn("_part", _part_of_day(shared))
    if "ingest_seq" not in keys.columns:
        return sliced, ["_day", "_part"]
    # A row without a number comes last.
    landed = F.coalesce(F.shiftright("ingest_seq", LANDING_BITS), F.lit(1 << 62))
    ranges = F.when(F.col("_part") % 2 == 1, landed).otherwise(0)
    return sliced.withColumn("_range", ranges), ["_day", "_part", "_range"]


def stream_history(keys: DataFrame, shared: list[Column] | None = None) -> DataFrame:
    """Previous count, previous time and running number of each row in its series.

    `keys` has `_series`, `collected_at`, `viewer_count`, with (series, time) unique; rows that were
    given a run's time may share it, and follow each other as landed. A series is cut into slices
    (`in_slices`), so a hot or null id is spread over as many tasks as it has slices; one row per slice
    carries count, time and number to the next.
    """
    order = [F.col(c).asc_nulls_last() for c in ("collected_at", *TIES) if c in keys.columns]
    sliced, cut = in_slices(keys, shared)
    by_slice = [SERIES, *cut]
    sliced = sliced.repartition(*by_slice)
    inside = Window.partitionBy(*by_slice).orderBy(*order)
    slices = Window.partitionBy(SERIES).orderBy(*cut)
    numbered = sliced.withColumns(
        {
            "_nth": F.row_number().over(inside),
            "_prev_count": F.lag("viewer_count").over(inside),
            "_prev_at": F.lag("collected_at").over(inside),
        }
    )
    carried = slice_tails(numbered, by_slice).select(
        *by_slice,
        F.lag("_last_count").over(slices).alias("_carry_count"),
        F.lag("_last_at").over(slices).alias("_carry_at"),
        F.coalesce(
            F.sum("_rows").over(slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_carry_rows"),
    )
    added = (*cut, "_nth", "_prev_count", "_prev_at", "_carry_count", "_carry_at", "_carry_rows")
    joined = numbered.join(carried, by_slice).withColumns(continued())
    return joined.drop(*added, "ingest_seq")


def continued() -> dict:
    """History columns from a row's place in its slice and what the slices before carry."""
    first = F.col("_nth") == 1
    return {
        "previous_viewer_count": F.when(first, F.col("_carry_count")).otherwise(
            F.col("_prev_count")
        ),
        "previous_collected_at": F.when(first, F.col("_carry_at")).otherwise(F.col("_prev_at")),
        "stream_snapshot_number": (
            F.col("_nth") + F.coalesce(F.col("_carry_rows"), F.lit(0))
        ).cast("int"),
    }
