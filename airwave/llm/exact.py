"""Exact duplicates by deterministic block naming, in DataFrame operations only.

A text's bytes are cut into blocks of one size. Distinct blocks are sorted and numbered: equal blocks,
and only these, get equal integers. Then neighbouring names are paired, the distinct pairs sorted and
numbered, and so on, until one name is left per document; with the number of rounds it is the
document's identity. There are no hashes that could collide: names stand for sorted values.

A value that occurs once needs no number. Whatever holds it is unlike any other, so it carries null
upwards, and only values that occur again are sorted, stored and joined. Those joins are between two
plain shuffles, which Spark splits where a value is frequent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.llm.common import free_names
from airwave.session import stored

#: Bytes of a block.
BLOCK = 4096
SPACES = r"[\x20\x09-\x0D]+"
IN_PARTITION = (1 << 33) - 1


def normalised(column: str = "text") -> F.Column:
    """The text by which documents are compared: each run of white space is one space."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.regexp_replace(text, SPACES, " ")


def numbered(values: DataFrame) -> DataFrame:
    """Distinct rows with `name`, their place in the sorted order of all of them."""
    columns = values.columns
    placed = stored(
        values.orderBy(*columns)
        .withColumn("id", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("id", 33))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort.
    parts = placed.groupBy("part").count()
    parts = parts.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = F.col("id").bitwiseAND(F.lit(IN_PARTITION))
    return placed.join(F.broadcast(parts), "part").select(
        *columns, (F.col("base") + within).alias("name")
    )


def named(rows: DataFrame, columns: list[str]) -> DataFrame:
    """`rows` with `name` in place of the columns: equal values, equal names; null where alone."""
    values = rows.where(F.col(columns[0]).isNotNull()).groupBy(*columns)
    repeated = values.count().where("count > 1").drop("count")
    return rows.join(numbered(repeated), columns, "left").drop(*columns)


def identities(docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, sha, copy, copies), one per row of `docs`; and (doc_id, sha, rounds, name) per document."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("text"))
    data = text.select(
        "doc_id", F.sha2("text", 256).alias("sha"), F.col("text").cast("binary").alias("data")
    )
    cut = data.select(
        "doc_id",
        "sha",
        F.expr(f"greatest(1L, ceil(octet_length(data) / {block}))").cast("long").alias("left"),
        F.posexplode(
            F.expr(
                "transform(sequence(0L, greatest(1L, ceil(octet_length(data) / "
                f"{block})) - 1), i -> substring(data, int(i * {block} + 1), {block}))"
            )
        ).alias("place", "block"),
    )
    key = ["doc_id", "sha"]
    level = stored(named(cut, ["block"]))
    same_row = Window.partitionBy(*key).orderBy("place")
    rows = level.where("place = 0").select(
        *key,
        F.row_number().over(same_row).alias("copy"),
        F.count("*").over(Window.partitionBy(*key)).alias("copies"),
    )
    longest = level.agg(F.max("left")).first()[0] or 1
    level = level.distinct()
    done = []
    rounds = 0
    while True:
        done.append(
            level.where("left = 1").select(*key, F.lit(rounds).alias("rounds"), "name")
        )
        if longest == 1:
            break
        # An odd last name is paired with -1; a null name on either side makes the pair null.
        pairs = (
            level.where("left > 1")
            .groupBy(
                *key,
                F.expr("ceil(left / 2)").cast("long").alias("left"),
                F.expr("place div 2").cast("int").alias("place"),
            )
            .agg(
                F.max(F.expr("if(place % 2 = 0, name, null)")).alias("first"),
                F.max(F.expr("if(place % 2 = 1, name, null)")).alias("second"),
                F.count_if(F.col("name").isNull()).alias("alone"),
            )
            .select(
                *key,
                "left",
                "place",
                F.expr("if(alone > 0, null, first)").alias("first"),
                F.expr("if(alone > 0, null, coalesce(second, -1L))").alias("second"),
            )
        )
        level = stored(named(pairs, ["first", "second"]))
        longest = -(-longest // 2)
        rounds += 1
    return rows, reduce(DataFrame.unionByName, done)


def exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of `docs`.

    Texts are compared after white-space runs became single spaces; null counts as empty. The smallest
    doc_id of equal texts stays, null ids come last, and of repeated rows one stays. Other columns are
    left out. An empty table gives no rows.
    """
    rows, names = identities(docs, block)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("doc_id", "sha")]
    found = stored(
        rows.alias("r").join(names.alias("n"), same).select("r.*", "n.rounds", "n.name")
    )
    groups = stored(
        found.where("name IS NOT NULL")
        .groupBy("rounds", "name")
        .agg(F.min("doc_id").alias("keep"), F.count("*").alias("size"))
    )
    kept = (F.col("doc_id").eqNullSafe(F.col("keep_id"))) & (F.col("copy") == 1)
    alone = F.col("size").isNull()
    return (
        found.join(groups, ["rounds", "name"], "left")
        .select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
            F.coalesce("size", "copies").alias("group_size"),
            "copy",
            F.col("sha").alias("text_sha256"),
        )
        .select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
    )


#: The same rows in DuckDB's SQL, for tables whose doc_ids are unique.
EXACT_SQL = r"""
WITH normal AS (
    SELECT doc_id,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text
    FROM documents
)
SELECT doc_id,
    min(doc_id) OVER (PARTITION BY text) AS keep_id,
    count(*) OVER (PARTITION BY text) AS group_size,
    doc_id = min(doc_id) OVER (PARTITION BY text) AS kept,
    sha256(text) AS text_sha256
FROM normal
"""


def drop_exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; of repeated rows one stays."""

    def row_key(sha: F.Column) -> F.Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), sha)

    key, nth = free_names(docs, "row_key", "nth")
    verdict = exact_duplicates(docs, block).where("kept")
    stays = stored(verdict.select(row_key(F.col("text_sha256")).alias(key)))
    keyed = docs.withColumn(key, row_key(F.sha2(normalised(), 256)))
    # The window is over the join's own partitioning: texts are shuffled once.
    again = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1)))
    found = keyed.join(stays, key, "left_semi").withColumn(nth, again)
    return found.where(F.col(nth) == 1).select(*docs.columns)
