"""First-row deduplication and schema-growing union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SNAPSHOT_KEYS = ("id", "collected_at")


def first_rows(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The `k` lowest rows in `order` per key; null keys are equal.

    `row_number() <= k` lets Spark place a group limit before the shuffle, so each task sends at most
    `k` rows per key however many copies it read.
    """
    if not keys:
        return df
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).where(f"_nth <= {k}").drop("_nth")


def drop_duplicate_snapshots(df: DataFrame, order: list[Column]) -> DataFrame:
    """First row per `(id, collected_at)`, or per whichever of the two the table has."""
    return first_rows(df, [k for k in SNAPSHOT_KEYS if k in df.columns], order)


def union_growing(*frames: DataFrame) -> DataFrame:
    """Union by name; a column that only some frames have is null in the others."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
