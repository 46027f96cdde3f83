"""The join forms of the engine. A side is broadcast only where a limit fixes its size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_batches(df: DataFrame, threshold: int = 900) -> DataFrame:
    """Rows of batches that hold at least `threshold` rows; rows without a batch time go."""
    sizes = (
        df.where(F.col("collected_at").isNotNull())
        .groupBy("collected_at")
        .agg(F.count(F.lit(1)).alias("_size"))
    )
    full = sizes.where(F.col("_size") >= threshold).select("collected_at")
    return df.join(full, "collected_at", "left_semi").select(*df.columns)


def join_top(df: DataFrame, top: DataFrame, on: list[str]) -> DataFrame:
    """Inner join with a short list of keys (a top-k result). Null keys match each other."""
    renamed = top.withColumnsRenamed({name: f"_top_{name}" for name in on})
    matched = [F.col(name).eqNullSafe(F.col(f"_top_{name}")) for name in on]
    return df.join(F.broadcast(renamed), matched, "inner").drop(*[f"_top_{n}" for n in on])


def keep_top(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a short list of keys (a top-k result). Null matches null."""
    wanted = top.select(F.col(key).alias("_top"))
    return df.join(F.broadcast(wanted), F.col(key).eqNullSafe(F.col("_top")), "left_semi")


def batches_not_in(df: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows whose `collected_at` is in no row of `loaded`; Spark picks the strategy by size."""
    known = loaded.select("collected_at").distinct()
    return df.join(known, "collected_at", "left_anti").select(*df.columns)
