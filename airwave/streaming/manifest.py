"""Which folders make up the incremental table, as of each micro-batch.

A micro-batch writes its rows to one folder per day and then a manifest: the live folders of all days, and the
table's columns. Readers take the newest finished manifest, so they list the folders of the days they want and
no others, need no file's footer, and never see a half-written micro-batch.

Folders of a day have levels. When a day has `fan` folders of a level, they are merged into one of the next, which
keeps the newest version of each row only. A merged folder carries the number of the last micro-batch in it, and
only neighbours are merged, so that what is newer stays newer. A day thus has fewer than `fan` folders per level,
and a row is rewritten once per level.

The manifests of the last micro-batches are kept, for readers under way and for a repeated micro-batch. A manifest
also says which folders its merges replaced; they are removed once no kept manifest can name them.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from airwave.sinks.files import exists, remove, values_of

#: Folders of one level that a day may have; manifests that are kept.
FAN, KEPT = 8, 3
#: Folder column below a micro-batch: the day of the row.
DAY = "_day"
EPOCH = "batch_id"
FOLDER_COLUMNS = [T.StructField(EPOCH, T.LongType()), T.StructField(DAY, T.DateType())]


@dataclass(frozen=True, order=True)
class Folder:
    """A live folder: its day, the last micro-batch in it, its level and its path below the table."""

    day: str
    epoch: int
    level: int
    path: str


@dataclass(frozen=True)
class Manifest:
    """All live folders after a micro-batch, the columns that rows have, and what merges replaced."""

    epoch: int
    folders: tuple[Folder, ...]
    columns: T.StructType
    replaced: tuple[str, ...] = ()

    def days(self) -> list[date]:
        return [date.fromisoformat(d) for d in sorted({f.day for f in self.folders})]


def _path(out: str, epoch: int) -> str:
    return f"{out}/manifest/epoch={epoch}"


def _epochs(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the manifests that were written to their end."""
    found = sorted(map(int, values_of(spark, f"{out}/manifest", "epoch")))
    return [e for e in found if exists(spark, f"{_path(out, e)}/_SUCCESS")]


def _read(spark: SparkSession, out: str, epochs: list[int]) -> dict[int, Manifest]:
    """Some manifests in one read: a line per live folder, and one with the columns."""
    reader = spark.read.schema("value string, epoch long").option("basePath", f"{out}/manifest")
    given = defaultdict(list)
    for row in reader.text([_path(out, e) for e in epochs]).collect():
        given[row["epoch"]].append(json.loads(row["value"]))
    found = {}
    for epoch, lines in given.items():
        head = next(g for g in lines if "columns" in g)
        folders = sorted(Folder(**g) for g in lines if "columns" not in g)
        columns = T.StructType.fromJson(head["columns"])
        found[epoch] = Manifest(epoch, tuple(folders), columns, tuple(head["replaced"]))
    return found


def read_manifest(spark: SparkSession, out: str, before: int | None = None) -> Manifest | None:
    """The newest manifest, or the newest that a micro-batch builds on; null if there is none."""
    epochs = [e for e in _epochs(spark, out) if before is None or e < before]
    if not epochs:
        return _from_listing(spark, out, before)
    return _read(spark, out, epochs[-1:])[epochs[-1]]


def _from_listing(spark: SparkSession, out: str, before: int | None) -> Manifest | None:
    """What a table holds that was written before there were manifests."""
    folders = [
        Folder(day, int(epoch), 0, f"rows/{EPOCH}={epoch}/{DAY}={day}")
        for epoch in values_of(spark, f"{out}/rows", EPOCH)
        if before is None or int(epoch) < before
        for day in values_of(spark, f"{out}/rows/{EPOCH}={epoch}", DAY)
    ]
    if not folders or values_of(spark, f"{out}/manifest", "epoch"):
        return None
    # Once, before the first manifest is written.
    found = spark.read.option("mergeSchema", "true").parquet(f"{out}/rows").schema
    columns = T.StructType([f for f in found if f.name not in (DAY, EPOCH)])
    return Manifest(max(f.epoch for f in folders), tuple(sorted(folders)), columns)


def write_manifest(spark: SparkSession, out: str, manifest: Manifest, kept: int = KEPT) -> None:
    """Make a micro-batch visible, and remove what is older than the last `kept` ones need."""
    head = {"columns": manifest.columns.jsonValue(), "replaced": manifest.replaced}
    lines = [json.dumps(head), *(json.dumps(asdict(f)) for f in manifest.folders)]
    rows = spark.createDataFrame([(line,) for line in lines], "value string")
    rows.coalesce(1).write.mode("overwrite").text(_path(out, manifest.epoch))
    epochs = [e for e in _epochs(spark, out) if e <= manifest.epoch]
    if len(epochs) <= kept:
        return
    # The oldest manifest that stays does not name what it replaced, nor do later ones.
    last = len(epochs) - kept
    for old in _read(spark, out, epochs[: last + 1]).values():
        for path in old.replaced:
            remove(spark, f"{out}/{path}")
    for e in epochs[:last]:
        remove(spark, _path(out, e))


def rows_of(
    spark: SparkSession, out: str, manifest: Manifest, days: Iterable[date] | None = None
) -> DataFrame | None:
    """All versions of the rows of some days, or of all; null if the table has none of them."""
    wanted = None if days is None else {str(d) for d in days}
    folders = [f for f in manifest.folders if wanted is None or f.day in wanted]
    return read_folders(spark, out, folders, manifest.columns) if folders else None


def read_folders(
    spark: SparkSession, out: str, folders: list[Folder], columns: T.StructType
) -> DataFrame:
    """The rows of some folders, with their day and micro-batch. Only these are listed; no footer is read."""
    schema = T.StructType([*columns.fields, *FOLDER_COLUMNS])
    by_root: dict[str, list[str]] = defaultdict(list)
    for folder in folders:
        by_root[folder.path.split("/")[0]].append(f"{out}/{folder.path}")
    frames = [
        spark.read.schema(schema).option("basePath", f"{out}/{root}").parquet(*paths)
        for root, paths in sorted(by_root.items())
    ]
    return reduce(DataFrame.unionByName, frames)


def due(folders: Iterable[Folder], fan: int = FAN) -> dict[str, list[Folder]]:
    """By day, the neighbouring folders to merge now: all of the lowest levels, up to the highest full one."""
    by_day: dict[str, list[Folder]] = defaultdict(list)
    for folder in sorted(folders):
        by_day[folder.day].append(folder)
    merged = {}
    for day, own in by_day.items():
        full = -1
        for level in range(max(f.level for f in own) + 1):
            # A merge of the levels below adds one folder here.
            if sum(f.level == level for f in own) + (level > 0) < fan:
                break
            full = level
        if full >= 0:
            merged[day] = [f for f in own if f.level <= full]
    return merged
