"""Which landed pages the raw table holds.

Each write to the raw table has an entry of the same number: the pages it took in, one row each. The entry is
written first and counts once the raw folder of that number is finished, so pages and rows are committed together.
Entries of unfinished writes are ignored. Many small entries are put together from time to time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airwave.sinks.files import exists, remove, values_of

PAGES = "file string, length long, run_ts string, page_no int, final boolean"
#: Entries after which they are put together.
MANY = 64


def ledger_of(raw: str) -> str:
    """The ledger lies beside the raw table, so that reading the table does not see it."""
    return f"{raw.rstrip('/')}.ledger"


def _finished(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/_SUCCESS")


def _valid(spark: SparkSession, raw: str) -> list[str]:
    ledger = ledger_of(raw)
    settled = [f"{ledger}/settled={n}" for n in values_of(spark, ledger, "settled")]
    entries = [
        f"{ledger}/batch_id={n}"
        for n in values_of(spark, ledger, "batch_id")
        if _finished(spark, f"{raw}/batch_id={n}")
    ]
    return [f for f in (*settled, *entries) if _finished(spark, f)]


def read_ledger(spark: SparkSession, raw: str) -> DataFrame | None:
    """One row per page that the raw table took in; null if nothing was noted yet."""
    folders = _valid(spark, raw)
    return spark.read.schema(PAGES).parquet(*folders) if folders else None


def note_pages(pages: DataFrame, raw: str, number: int, settled: bool = False) -> None:
    """Note pages for the write of this number; `settled` if there is nothing to write for them."""
    kind = "settled" if settled else "batch_id"
    names = [part.split()[0] for part in PAGES.split(", ")]
    rows = pages.select(*names).coalesce(1)
    rows.write.mode("overwrite").parquet(f"{ledger_of(raw)}/{kind}={number}")


def settle(spark: SparkSession, raw: str, number: int, many: int = MANY) -> None:
    """Put the entries together when there are many. Stopped in between, it leaves pages noted twice."""
    folders = _valid(spark, raw)
    if len(folders) >= many:
        note_pages(spark.read.schema(PAGES).parquet(*folders), raw, number, settled=True)
        for folder in folders:
            remove(spark, folder)
