"""Exact n-gram Jaccard self-join by vertical partitioning.

All shingles have one global order: those in one document first, then repeated ones by hash, the most
frequent last. Two sets that are similar enough share a shingle among the first few of each (the prefix), so
a document with enough shingles of its own has no partner, and only the rest is looked at.

1. Count the documents of every shingle: each task sorts its shingles and sends them by hash range, in
   compressed runs; a range's reducer adds up. A bitmap of fixed size says which shingles occur again; a
   shingle of one document that falls on another's bit is only taken for a repeated one. A list of
   fixed length holds the most frequent.
2. Equal sets become one class. Prefix shingles that two classes share make candidate pairs.
3. A pair's overlap is counted by fragments: the hash order is cut at fixed places, each fragment of a
   set is intersected with the partner's same fragment, and the partial counts are summed per pair.
4. Pairs are tried in two rounds. First each class meets the most central class of its lists, so that a
   group of near copies needs as many pairs as it has members. Then pairs that still lie in different
   components are tried, so that no link that matters is lost. Of these, most never are counted: where two
   sets meet in a first common shingle, what follows it in either set bounds their overlap, and so do the
   numbers of repeated shingles that both have in each of many stretches of the hash order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import Batches, in_tasks, ship, slices, texts
from airwave.llm.components import component_labels
from airwave.llm.shingles import WORDS, shingle_sets
from airwave.session import stored

#: Least similarity, in percent.
PERCENT = 80
#: Bits of the bitmap of repeated shingles: 16 MB.
BITMAP_BITS = 27
#: Length of the list of frequent shingles, and the least number of documents to be in it.
FREQUENT = 1 << 18
FREQUENT_FROM = 32
#: Shingles that a counting task holds before it sends them.
HELD = 1 << 21
#: Fragments of the hash order in which overlaps are counted, and stretches in which they are bounded.
FRAGMENTS, STRETCH_BITS = 16, 6

RUNS = "range int, keys binary, counts binary"
COUNTED = "range int, repeated binary, keys binary, counts binary"
SETS = (
    "doc_id long, text_key long, n long, class long, alone long, prefix array<long>, "
    "spread array<int>, shingles array<long>"
)


@dataclass
class Order:
    """What the global order needs to know: bitmap of repeated shingles, and the frequent ones."""

    repeated: np.ndarray
    keys: np.ndarray
    counts: np.ndarray

    def weight(self, shingles: np.ndarray) -> np.ndarray:
        """0: in one document; 1: repeated; above: the number of documents of a frequent one."""
        key = (shingles >> np.uint64(32)).astype(np.uint32)
        bit = key >> np.uint32(32 - BITMAP_BITS)
        weight = (self.repeated[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1
        weight = weight.astype(np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            weight = np.where(self.keys[at] == key, self.counts[at], weight)
        return weight


def prefix_length(n: int, percent: int) -> int:
    """Two sets of the least similarity share one of so many first shingles."""
    return n - -(-percent * n // 100) + 1


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.astype("<u4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<u4")


def count_shingles(docs: DataFrame, words: int, ranges: int) -> Order:
    """Document counts of all shingles of `docs` (doc_id, text), by ranges of the hash.

    `ranges` is a power of two. Counts are kept per 32 high bits of the hash.
    """
    high = ranges.bit_length() - 1
    per_range = FREQUENT // ranges

    def runs(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def sent() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            bounds = np.searchsorted(keys, np.arange(1, ranges, dtype=np.int64) << (32 - high))
            rows = [
                (r, _packed(np.diff(k, prepend=np.uint32(0))), _packed(c))
                for r, (k, c) in enumerate(
                    zip(np.split(keys, bounds), np.split(counts, bounds), strict=True)
                )
                if len(k)
            ]
            r, k, c = zip(*rows, strict=True)
            arrays = [pa.array(r, pa.int32()), pa.array(k, pa.binary()), pa.array(c, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["range", "keys", "counts"])

        for _, values in slices(batches, 64):
            for shingles in shingle_sets(values, words):
                if len(shingles):
                    held.append((shingles >> np.uint64(32)).astype(np.uint32))
                    size += len(shingles)
            if size >= HELD:
                yield sent()
                held, size = [], 0
        if size:
            yield sent()

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.cumsum(_unpacked(k), dtype=np.uint32) for k in rows["keys"]])
        counts = np.concatenate([_unpacked(c) for c in rows["counts"]]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        span = 1 << (BITMAP_BITS - high)
        bits = np.zeros(span, bool)
        bits[(keys[counts > 1] >> np.uint32(32 - BITMAP_BITS)) & np.uint32(span - 1)] = True
        # Of equal counts the smaller key is listed.
        top = np.lexsort((keys, -counts))[:per_range]
        top = np.sort(top[counts[top] >= FREQUENT_FROM])
        return pd.DataFrame(
            {
                "range": rows["range"].iloc[:1].to_numpy(),
                "repeated": [np.packbits(bits).tobytes()],
                "keys": [keys[top].tobytes()],
                "counts": [counts[top].tobytes()],
            }
        )

    counted = in_tasks(docs, runs, RUNS).groupBy("range").applyInPandas(add, COUNTED)
    repeated = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    keys, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    size = len(repeated) // ranges
    # Bounded: a slice of the bitmap and a stretch of the list per range.
    for row in sorted(counted.collect(), key=lambda row: row["range"]):
        at = row["range"] * size
        repeated[at : at + size] = np.frombuffer(row["repeated"], np.uint8)
        keys.append(np.frombuffer(row["keys"], np.uint32))
        counts.append(np.frombuffer(row["counts"], np.int64))
    return Order(repeated, np.concatenate(keys), np.concatenate(counts))


def document_sets(docs: DataFrame, order: Order, words: int, percent: int) -> DataFrame:
    """Rows of SETS from (doc_id, text, text_key); the rest only where there may be a partner.

    `alone` counts the shingles that no other document has; they come first in the order, before `prefix`.
    `spread` counts the other ones by stretch of the hash order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = ["n", "class", "alone", "prefix", "spread", "shingles"]
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        kinds = [pa.int64(), pa.int64(), pa.int64(), longs, ints, longs]
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                rows = []
                for shingles in shingle_sets(part.column(1).to_pylist(), words):
                    n = len(shingles)
                    rows.append((n, None, None, None, None, None))
                    if not n:
                        continue
                    weight = known.weight(shingles)
                    first = prefix_length(n, percent)
                    alone = int(np.count_nonzero(weight == 0))
                    if alone >= first:
                        continue
                    chosen = np.lexsort((shingles, weight))[alone:first]
                    others = shingles[weight > 0] >> np.uint64(64 - STRETCH_BITS)
                    spread = np.bincount(others.astype(np.int64), minlength=1 << STRETCH_BITS)
                    name = np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64)
                    prefix = shingles[chosen].view(np.int64)
                    rows[-1] = (n, name, alone, prefix, spread.astype(np.int32), shingles.view(np.int64))
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), *arrays], ["doc_id", "text_key", *names]
                )

    return in_tasks(docs, run, SETS)


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of `pairs` (a, b) those similar enough; `sets` has (class, n, part, shingles) by fragment."""
    left = sets.select(
        F.col("class").alias("a"), F.col("n").alias("na"), "part", F.col("shingles").alias("x")
    )
    right = sets.select(
        F.col("class").alias("b"), F.col("n").alias("nb"), "part", F.col("shingles").alias("y")
    )
    counted = (
        pairs.join(left, "a")
        .join(right, ["b", "part"])
        .select("a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).alias("shared"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("shared").alias("shared"))
    )
    return counted.where(f"100 * shared >= {percent} * (na + nb - shared)").select("a", "b")


def lengths_fit(a: str, b: str, percent: int) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def overlap_fits(most: str, percent: int) -> str:
    """Can sets of sizes n_a and n_b be similar if they share `most` shingles at most?"""
    return f"100 * {most} >= {percent} * (n_a + n_b - {most})"


def open_pairs(lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of classes with different labels that may be similar; `lists` has shingle, class, n, place, label.

    `place` is a shingle's place in the order of its set. The smaller set of a similar pair has their first common
    shingle among so few that sets of its own size would share (the others are not tried), the larger one in its
    prefix. Pairs are made where the bounds of the module's fourth step let them be similar, and nowhere else.
    """
    spreads = classes.select("class", "spread")
    wide = stored(lists.join(spreads, "class"))
    columns = ("class", "n", "label", "place", "spread")
    few = f"n - (2 * {percent} * n + {99 + percent}) div {100 + percent}"
    a = wide.where(f"place <= {few}").select("shingle", *[F.col(c).alias(f"{c}_a") for c in columns])
    b = wide.select("shingle", *[F.col(c).alias(f"{c}_b") for c in columns])
    after = "least(n_a - place_a, n_b - place_b)"
    shared = "aggregate(zip_with(spread_a, spread_b, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
    fits = [
        "(n_a < n_b OR (n_a = n_b AND class_a < class_b))",
        "label_a <> label_b",
        lengths_fit("n_a", "n_b", percent),
        overlap_fits(after, percent),
        overlap_fits(shared, percent),
    ]
    met = a.join(b, (a["shingle"] == b["shingle"]) & F.expr(" AND ".join(fits)))
    return met.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()


def links(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between classes that connect all that are connected, and the labels they give."""
    cut = f"transform(sequence(0, {FRAGMENTS - 1}), p -> struct(p AS part, filter(shingles, s -> "
    # The high bits of the hash, so a fragment is a stretch of the hash order.
    cut += f"shiftrightunsigned(s, {64 - FRAGMENTS.bit_length() + 1}) = p) AS shingles))"
    sets = stored(
        classes.select("class", "n", F.expr(f"inline({cut})")).where("size(shingles) > 0")
    )
    lists = classes.select("class", "n", "alone", F.posexplode("prefix").alias("place", "shingle"))
    lists = lists.withColumn("place", F.col("alone") + F.col("place")).drop("alone")
    shared = stored(lists.groupBy("shingle").count().where("count > 1").select("shingle"))
    lists = stored(lists.join(shared, "shingle"))

    # Central is who has the fewest prefix shingles that no other class has.
    first = f"n - ceil({percent} * n / 100) + 1"
    central = lists.groupBy("class", "n").agg((F.expr(first) - F.count("*")).alias("own"))
    ranked = stored(lists.join(stored(central.select("class", "own")), "class"))
    heads = ranked.groupBy("shingle").agg(F.min(F.struct("own", "class", "n")).alias("head"))
    heads = stored(heads.select("shingle", "head"))
    met = (
        ranked.join(heads, "shingle")
        .where("head.class <> class")
        .where(lengths_fit("head.n", "n", percent))
        .groupBy(F.col("class").alias("b"), F.col("head.class").alias("a"))
        .agg(F.count("*").alias("times"), F.first("head.own").alias("own"))
        .groupBy("b")
        .agg(F.max(F.struct("times", F.expr("-own"), "a")).alias("best"))
    )
    first_links = stored(similar(stored(met.select("best.a", "b")), sets, percent))
    labels = component_labels(first_links)

    known = labels.select(F.col("node").alias("class"), "label")
    labelled = stored(
        lists.join(known, "class", "left").withColumn("label", F.coalesce("label", "class"))
    )
    split = labelled.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("up"))
    split = stored(split.where("low < up").select("shingle"))
    open_lists = stored(labelled.join(split, "shingle"))
    rest = open_pairs(open_lists, classes, percent)
    second_links = stored(similar(stored(rest), sets, percent))
    if second_links.isEmpty():
        return first_links, labels
    all_links = stored(first_links.unionByName(second_links))
    return all_links, component_labels(all_links)


def jaccard_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of `docs` (doc_id, text, ...).

    Words are separated by ASCII white space and A-Z lower-cased. Two documents are linked if their
    sets of distinct shingles have a Jaccard similarity of at least `percent` / 100; component_id is the
    smallest doc_id that links lead to. Null texts and texts without words have no shingles and no
    links, nor has a set that no other shares enough with: their component is their own doc_id, null for
    a null one. Repeated rows are linked. Other columns are left out; an empty table gives no rows.
    """
    sets, found = _components(docs, words, percent)
    return sets.select("doc_id", "n", "class").join(found, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def _text_key(column: str = "text") -> F.Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def _components(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows of SETS, one per row of `docs`; and (class, label, component_id) of the classes."""
    spark = docs.sparkSession
    ship(spark)
    given = texts(docs)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 1 << max(4, min(12, (partitions - 1).bit_length()))
    order = count_shingles(given, words, ranges)
    keyed = given.withColumn("text_key", _text_key())
    sets = stored(document_sets(keyed, order, words, percent))
    classes = stored(
        sets.where("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("doc_id"),
            *[F.first(c).alias(c) for c in ("n", "alone", "prefix", "spread", "shingles")],
        )
    )
    _, labels = links(classes, percent)
    placed = classes.select("class", "doc_id").join(
        labels.withColumnRenamed("node", "class"), "class", "left"
    )
    placed = stored(placed.withColumn("label", F.coalesce("label", "class")))
    least = stored(placed.groupBy("label").agg(F.min("doc_id").alias("component_id")))
    return sets, stored(placed.select("class", "label").join(least, "label"))


def drop_near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each component one text.

    That of the smallest doc_id stays, null ids come last; of several texts of that id, the one whose class is
    smallest. A doc_id may have texts in several components, and each is judged on its own. Equal rows are
    not told apart: they stay or go together, as do equal shingle sets of one doc_id.
    """
    sets, found = _components(docs, words, percent)
    rows = sets.where("class IS NOT NULL").select("doc_id", "text_key", "class")
    rows = stored(rows.join(found.select("class", "label"), "class"))
    kept = rows.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "class")).alias("kept")
    )
    same = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("class") == F.col("kept.class"))
    dropped = rows.join(stored(kept), "label").where(~same)
    # Names that the documents cannot have given.
    dropped = stored(dropped.select(F.col("doc_id").alias("id"), "text_key").distinct()).alias("dropped")
    given = docs.alias("given")
    goes = F.col("given.doc_id").cast("long").eqNullSafe(F.col("dropped.id"))
    goes &= _text_key("given.text") == F.col("dropped.text_key")
    return given.join(dropped, goes, "left_anti").select(*docs.columns)
