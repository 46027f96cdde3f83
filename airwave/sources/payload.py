"""Landed API pages. Whatever fetches the pages adds `run_ts` and `page_no` to each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airwave.functions.coerce import ISO_DATE
from airwave.schema import CATEGORY, PAYLOAD_STREAM, RAW_COLUMNS, payload

# Landing order: second of the run, page, place on the page, in 15 bits each for the latter two.
PAGE_BITS = 15
PAGE_OPTIONS = {"multiLine": "true", "mode": "FAILFAST"}


def read_pages(
    spark: SparkSession, path: str | list[str], stream: T.StructType = PAYLOAD_STREAM
) -> DataFrame:
    """Pages from JSON files, one document per file. A wider `stream` keeps new API fields.

    A broken or half-written page is an error, not an empty page.
    """
    return spark.read.schema(payload(stream)).options(**PAGE_OPTIONS).json(path)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length) of what lies in a folder. Files are listed, their content is not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length")
    )


def is_final() -> Column:
    """Does a page end its run? It is empty or has no cursor."""
    cursor = F.col("pagination.cursor")
    return (F.coalesce(F.size("data"), F.lit(0)) <= 0) | cursor.isNull() | (cursor == "")


def run_ends(pages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(_run, _cut): the first final page of each run, null if there is none.

    `known` has such rows from elsewhere, for runs whose other pages are not among `pages`.
    """
    own = pages.select(
        F.col("run_ts").alias("_run"), F.when(is_final(), F.col("page_no")).alias("_cut")
    )
    both = own if known is None else own.unionByName(known)
    return both.where(F.col("_run").isNotNull()).groupBy("_run").agg(F.min("_cut").alias("_cut"))


def pages_in_run(
    pages: DataFrame, max_pages: int | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Pages up to the run's first page that is empty or has no cursor; `max_pages` cuts earlier.

    That page still counts (an empty one adds no rows); anything after it does not belong to the
    run. The cut is one number per run (`run_ends`), joined back by run. Pages without `run_ts` belong to
    runs that cannot be told apart, so all of them stay.
    """
    cuts = run_ends(pages, known)
    limit = F.least(F.lit(max_pages).cast("int"), F.col("_cut"))
    beyond = F.col("page_no") > limit
    kept = pages.join(cuts, F.col("run_ts") == F.col("_run"), "left")
    return kept.where(~F.coalesce(beyond, F.lit(False))).drop("_run", "_cut")


def join_list(df: DataFrame, name: str):
    """A list column as text joined by ", "; any other column as it is."""
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return F.array_join(name, ", ")
    return F.col(name)


def run_stamp() -> Column:
    """A run's time; null where it cannot be read."""
    return F.when(F.col("run_ts").rlike(ISO_DATE), F.try_to_timestamp("run_ts"))


def stream_rows(pages: DataFrame) -> DataFrame:
    """One raw row per stream, stamped with its run's time and its landing order."""
    spread = pages.select(
        run_stamp().alias("_stamp"), "page_no", F.posexplode("data").alias("_pos", "_row")
    )
    second = F.coalesce(F.unix_seconds("_stamp"), F.lit(0))
    # A higher number would run into the next page's, and another duplicate would stay.
    most = (1 << PAGE_BITS) - 1
    page_no, place = (
        F.when(F.col(c).between(0, most), F.col(c)).otherwise(
            F.raise_error(F.lit(f"{c} is not between 0 and {most}"))
        )
        for c in ("page_no", "_pos")
    )
    page = F.shiftleft(second, PAGE_BITS) + page_no
    rows = spread.select(
        "_row.*",
        F.date_format("_stamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("collected_at"),
        (F.shiftleft(page, PAGE_BITS) + place).alias("ingest_seq"),
    )
    lists = [c for c in ("tags", "tag_ids") if c in rows.columns]
    return rows.withColumns({name: join_list(rows, name) for name in lists})


def snapshot_rows(
    pages: DataFrame, max_pages: int | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Raw rows of landed runs. A run whose time is unreadable keeps its rows, without a time."""
    return stream_rows(pages_in_run(pages, max_pages, known))


def read_categories(
    spark: SparkSession, path: str, first: int = 10, category: T.StructType = CATEGORY
) -> DataFrame:
    """The first entries of each landed top-categories document, in their order.

    A broken or half-written document is an error, not an empty one.
    """
    envelope = T.StructType([T.StructField("data", T.ArrayType(category))])
    documents = spark.read.schema(envelope).options(**PAGE_OPTIONS).json(path)
    return (
        documents.select(F.posexplode("data").alias("position", "_row"))
        .where(F.col("position") < first)
        .select("position", "_row.*")
    )


def raw_projection(rows: DataFrame) -> DataFrame:
    """All raw columns as text, absent ones null, then the landing order, then new fields."""
    known = [
        (F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(c)
        for c in RAW_COLUMNS
    ]
    seq = F.col("ingest_seq") if "ingest_seq" in rows.columns else F.lit(None)
    extra = [c for c in rows.columns if c not in (*RAW_COLUMNS, "ingest_seq")]
    return rows.select(*known, seq.cast("bigint").alias("ingest_seq"), *extra)
