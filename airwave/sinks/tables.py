"""Raw, enriched and summary outputs."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from airwave.plans.enrich import report_order
from airwave.sources.payload import raw_projection
from airwave.sources.snapshots import CSV


def new_number() -> int:
    """A number for a batch write; those of streams are not negative."""
    return -time.time_ns()


def append_raw(
    rows: DataFrame, path: str, on_empty: str = "error", number: int | None = None
) -> int:
    """Append rows to the raw table and return their number.

    New fields are kept as new columns; older files simply lack them. An empty batch is an error,
    or with `on_empty="skip"` a no-op. `number` names the write; none is given twice.
    """
    if on_empty not in ("error", "skip"):
        raise ValueError(f"unknown on_empty {on_empty!r}")
    if rows.isEmpty():
        if on_empty == "skip":
            return 0
        raise ValueError("the batch has no rows, nothing was written")
    counted = Observation()
    written = raw_projection(rows).observe(counted, F.count(F.lit(1)).alias("rows"))
    # Below a folder of its own, as the stream writes.
    written.write.parquet(f"{path}/batch_id={new_number() if number is None else number}")
    return counted.get["rows"]


def write_enriched(enriched: DataFrame, path: str) -> str:
    """Replace the enriched table, laid out by day and sorted as the report order wants.

    The range shuffle includes the id, so a batch of any size is split over tasks.
    """
    order = report_order(enriched)
    (
        enriched.repartitionByRange(*order)
        .sortWithinPartitions("snapshot_date", *order)
        .write.mode("overwrite")
        .partitionBy("snapshot_date")
        .parquet(path)
    )
    return path


def write_summaries(tables: dict[str, DataFrame], directory: str) -> list[str]:
    """One CSV output per table; returns the paths."""
    paths = []
    for name, table in tables.items():
        target = f"{directory}/{name}"
        table.write.mode("overwrite").options(header="true", escape=CSV["escape"]).csv(target)
        paths.append(target)
    return paths


def write_json(df: DataFrame, path: str) -> str:
    """UTF-8 JSON, one document per line."""
    df.write.mode("overwrite").json(path)
    return path
