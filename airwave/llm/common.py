"""What several operators share: tables, null-safe columns, text slices."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started.

    Spark's file server hands the archive to the executors, those that join later too.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


Batches = Iterable[pa.RecordBatch]
#: Characters of text that are encoded at once.
CHUNK = 8 << 20
#: What a Python worker keeps from task to task, by name, and how to let go of it.
_kept: dict[str, Callable[[], None]] = {}


def forget_between(forget: Callable[[], None], name: str) -> None:
    """Call `forget` in a worker before tasks that do not say that they keep `name`."""
    _kept[name] = forget


def in_tasks(
    df: DataFrame,
    run: Callable[[Batches], Iterator[pa.RecordBatch]],
    schema: str | T.StructType,
    keeps: str | None = None,
) -> DataFrame:
    """`mapInArrow` with this package at hand in the workers, which let go of what other tasks keep."""
    ship(df.sparkSession)

    def task(batches: Batches) -> Iterator[pa.RecordBatch]:
        forget_others(keeps)
        yield from run(batches)

    return df.mapInArrow(task, schema)


def forget_others(keeps: str | None) -> None:
    """Let go of what other tasks kept."""
    for name, forget in _kept.items():
        if name != keeps:
            forget()
    release_memory()


def release_memory() -> None:
    """Give memory that was freed back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a null text as the empty one; other columns are left behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the table has them."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name in taken:
            name = f"{name}_"
        found.append(name)
    return found


def text_chunks(
    batches: Iterable[pa.RecordBatch], size: int = CHUNK
) -> Iterator[tuple[list, list[str]]]:
    """The (doc_id, text) columns as Python lists of about `size` characters, or one longer text, at a time."""
    ids, values, held = [], [], 0
    for some_ids, some in slices(batches, 64):
        for doc_id, text in zip(some_ids, some, strict=True):
            ids.append(doc_id)
            values.append(text)
            held += len(text) + 64
            if held >= size:
                yield ids, values
                ids, values, held = [], [], 0
    if ids:
        yield ids, values


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[list, list[str]]]:
    """The (doc_id, text) columns of Arrow batches as Python lists of a few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()
