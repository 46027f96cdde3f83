"""Session settings the engine relies on."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# All calendar features are UTC; AQE coalesces small shuffles and splits skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Lets small shuffles keep all cores busy; large ones are cut by the advisory size anyway.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Fixed when a session starts. Call-site capture costs driver round trips per column expression.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(
    app_name: str = "airwave",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the engine's settings; `master` stays unset on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session someone else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where all runs in one process (tests)."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        named = tempfile.mkdtemp(prefix="airwave-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A new folder below the shared one, removed at the end."""
    path = f"{shared_dir(spark)}/airwave-scratch-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        removed(spark, path)


def removed(spark: SparkSession, path: str) -> None:
    # Through Hadoop's file system, as the folder may be on any storage.
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(place, True)


_place: ContextVar[str | None] = ContextVar("place", default=None)


@contextmanager
def stage_scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder that also takes what `stored` keeps meanwhile, for a stage whose result is written inside."""
    with scratch(spark) as folder:
        before = _place.set(folder)
        try:
            yield folder
        finally:
            _place.reset(before)


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The frame written once as Parquet in the shared folder, or below it, and read back.

    Cuts the lineage like a checkpoint, and later reads touch only the columns they need.
    """
    path = new_place(df.sparkSession, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_place(spark: SparkSession, folder: str | None = None) -> str:
    """A new path in the shared folder, or below `folder`."""
    return f"{folder or _place.get() or shared_dir(spark)}/airwave-{uuid.uuid4().hex}"
