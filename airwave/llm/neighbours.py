"""Approximate nearest neighbours from balanced posting lists.

Fit, on a bounded sample: the vectors are halved again and again across their widest direction, at the
median, so that all lists have one size; the means are the centroids. Centroids stay in memory, with a graph of
their nearest neighbours; a best-first search over the graph finds the lists of a vector.

Index, all rows: a vector goes to its nearest list and, near a boundary, to further ones whose centroid
is almost as near, unless that centroid lies close beside one taken already.

Search: a query looks into all lists whose centroid is at most a given ratio farther than its nearest. The ratio
is calibrated: sampled vectors are looked up among the sample, exactly, and the ratio is so wide that the lists
of nearly all their neighbours are within it. Lists and their queries are cut into parts of bounded size,
so a crowded list is many tasks; distances are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.llm.common import Batches, in_tasks
from airwave.session import stored

#: Vectors of a list in the sample's share, bytes of the sample, and its rows at most.
LIST_SIZE = 256
SAMPLE_BYTES = 32 << 20
SAMPLE_ROWS = 1 << 17
#: At least so many sampled vectors stand behind a centroid.
BEHIND = 16
#: A vector is copied to lists at most this much farther than its nearest, and to so many lists.
COPY_RATIO = 1.1
COPIES = 4
#: A further list is passed over if its centroid is nearer to a taken one than this share of its distance.
SPREAD = 0.25
#: A query looks into lists at least this much farther than its nearest.
SEARCH_RATIO = 1.1
#: Sampled queries for the calibration, and the share of their neighbours whose lists must be looked into.
TRIED, REACHED = 256, 0.98
EDGES = 20
#: Vectors, or queries, of one list that a task handles.
PART = 4096


def halve(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of `lists` (a power of two) equally large parts of the sample."""
    parts = [np.arange(len(sample))]
    while len(parts) < lists:
        halves = []
        for part in parts:
            centred = sample[part] - sample[part].mean(axis=0)
            # A few power steps find the widest direction well enough.
            direction = centred[np.argmax((centred**2).sum(axis=1))]
            for _ in range(8):
                direction = centred.T @ (centred @ direction)
                norm = np.linalg.norm(direction)
                if not norm:
                    break
                direction /= norm
            order = np.argsort(centred @ direction, kind="stable")
            middle = len(part) // 2
            halves += [part[order[:middle]], part[order[middle:]]]
        parts = halves
    return np.array([sample[part].mean(axis=0) for part in parts])


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x**2).sum(1)[:, None] - 2 * x @ y.T + (y**2).sum(1)[None, :])


@dataclass
class Lists:
    """Centroids, their graph, and the number of ids in each list once it is filled.

    An id counts in one of its lists only, so lists of together n ids hold n different ones at least.
    """

    centroids: np.ndarray
    graph: np.ndarray = field(init=False)
    sizes: np.ndarray | None = None
    ratio: float = SEARCH_RATIO

    def __post_init__(self) -> None:
        k = len(self.centroids)
        near = []
        for at in range(0, k, 512):
            distance = squared(self.centroids[at : at + 512], self.centroids)
            near.append(np.argsort(distance, axis=1, kind="stable")[:, : min(EDGES + 1, k)])
        rng = np.random.default_rng(3)
        # Neighbours in the order of halving, and far ones, keep the graph connected.
        ring = np.array([np.roll(np.arange(k), 1), np.roll(np.arange(k), -1)]).T
        self.graph = np.hstack([np.vstack(near), ring, rng.integers(0, k, (k, 2))])

    def nearest(self, vectors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the `width` nearest lists that the graph search finds, and distances."""
        k = len(self.centroids)
        width = min(width, k)
        entry = np.unique(np.linspace(0, k - 1, min(k, max(width, 16))).astype(np.int64))
        ids = np.tile(entry, (len(vectors), 1))
        distance = squared(vectors, self.centroids[entry])
        norms = (self.centroids**2).sum(axis=1)
        own = (vectors**2).sum(axis=1)
        order = np.argsort(distance, axis=1, kind="stable")[:, :width]
        ids = np.take_along_axis(ids, order, 1)
        distance = np.take_along_axis(distance, order, 1)
        done = np.zeros(ids.shape, bool)
        step = 4
        while True:
            open_distance = np.where(done, np.inf, distance)
            pick = np.argsort(open_distance, axis=1, kind="stable")[:, :step]
            fresh = np.isfinite(np.take_along_axis(open_distance, pick, 1))
            if not fresh.any():
                break
            np.put_along_axis(done, pick, True, 1)
            new = self.graph[np.take_along_axis(ids, pick, 1)].reshape(len(vectors), -1)
            far = own[:, None] + norms[new]
            far -= 2 * np.einsum("vd,vnd->vn", vectors, self.centroids[new])
            far = np.maximum(far, 0)
            far[~np.repeat(fresh, self.graph.shape[1], axis=1)] = np.inf
            known = (new[:, :, None] == ids[:, None, :]).any(axis=2)
            far[known] = np.inf
            # One node may come from several neighbours: the first of equal ids stays.
            sort = np.argsort(new, axis=1, kind="stable")
            ranked = np.take_along_axis(new, sort, 1)
            again = np.zeros(new.shape, bool)
            again[:, 1:] = ranked[:, 1:] == ranked[:, :-1]
            repeated = np.zeros(new.shape, bool)
            np.put_along_axis(repeated, sort, again, 1)
            # A repeated node can be finite in one place only if it is so in the first.
            first_finite = np.isfinite(far)
            far[repeated & first_finite] = np.inf
            all_ids = np.hstack([ids, new])
            all_distance = np.hstack([distance, far])
            all_done = np.hstack([done, np.zeros(new.shape, bool)])
            order = np.argsort(all_distance, axis=1, kind="stable")[:, :width]
            ids = np.take_along_axis(all_ids, order, 1)
            distance = np.take_along_axis(all_distance, order, 1)
            done = np.take_along_axis(all_done, order, 1) | ~np.isfinite(distance)
        return ids, np.sqrt(distance)

    def homes(self, vectors: np.ndarray) -> Iterator[tuple[int, int]]:
        """(row, list) of every vector's lists: the nearest, and those across a near boundary."""
        ids, distance = self.nearest(vectors, 4 * COPIES)
        for row in range(len(vectors)):
            taken: list[int] = []
            for name, far in zip(ids[row].tolist(), distance[row].tolist(), strict=True):
                if taken and (far > COPY_RATIO * distance[row, 0] or len(taken) == COPIES):
                    break
                gaps = self.centroids[taken] - self.centroids[name]
                if not taken or ((gaps**2).sum(axis=1) > (SPREAD * far) ** 2).all():
                    taken.append(name)
                    yield row, name

    def probes(self, vectors: np.ndarray, ratio: float, least: int) -> Iterator[tuple[int, int]]:
        """(row, list) of all lists that a query looks into, holding `least` ids at least."""
        width = 64
        rows = np.arange(len(vectors))
        while len(rows):
            ids, distance = self.nearest(vectors[rows], width)
            within = distance <= ratio * distance[:, :1]
            # Lists in front of the place where enough ids are together.
            before = np.cumsum(self.sizes[ids], axis=1) - self.sizes[ids]
            within |= before < least
            whole = within[:, -1] & (ids.shape[1] < len(self.centroids))
            for at in np.flatnonzero(~whole):
                for name in ids[at, within[at]].tolist():
                    yield int(rows[at]), name
            rows = rows[whole]
            width *= 2


def calibrated(lists: Lists, sample: np.ndarray, k: int) -> float:
    """The ratio that reaches the lists of REACHED of the sample's neighbours of some of its vectors.

    Neighbours in a sample lie farther off than those in the whole table, so the ratio is rather too wide.
    """
    rng = np.random.default_rng(11)
    tried = rng.choice(len(sample), min(TRIED, len(sample)), replace=False)
    needed = []
    for at in range(0, len(tried), 32):
        queries = sample[tried[at : at + 32]]
        far = squared(queries, sample)
        far[np.arange(len(queries)), tried[at : at + 32]] = np.inf
        near = np.argsort(far, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
        if not near.size:
            return SEARCH_RATIO
        homes: list[list[int]] = [[] for _ in range(near.size)]
        for row, name in lists.homes(sample[near.ravel()]):
            homes[row].append(name)
        to_lists = np.sqrt(squared(queries, lists.centroids))
        ratios = to_lists / np.maximum(to_lists.min(axis=1, keepdims=True), 1e-300)
        for place, names in enumerate(homes):
            needed.append(ratios[place // near.shape[1], names].min())
    return float(max(SEARCH_RATIO, np.quantile(needed, REACHED, method="higher")))


def scale_of(vectors: DataFrame) -> float:
    """A power of two near the largest component if squares might overflow or vanish, else 1."""
    largest = vectors.agg(F.max(F.expr("array_max(transform(v, x -> abs(x)))"))).first()[0]
    exponent = np.frexp(largest)[1] if largest else 0
    return 2.0 ** int(exponent) if abs(exponent) > 400 else 1.0


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors that take part, as arrays of doubles of the table's usual length."""
    v = F.col("embedding").cast("array<double>")
    sound = F.expr(
        "vec_id IS NOT NULL AND v IS NOT NULL "
        "AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
        "AND exists(v, x -> x <> 0)"
    )
    found = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(sound)
    usual = found.groupBy(F.size("v").alias("length")).count()
    usual = usual.orderBy(F.desc("count"), "length").limit(1).collect()
    return found.where(F.size("v") == (usual[0]["length"] if usual else 0))


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def fit(vectors: DataFrame, k: int = 10) -> Lists | None:
    """Lists from the vectors whose ids hash lowest, as many as SAMPLE_BYTES hold, and their search ratio."""
    head = vectors.select(F.size("v").alias("length")).first()
    if head is None:
        return None
    rows = min(SAMPLE_ROWS, max(1, SAMPLE_BYTES // (8 * head["length"])))
    total = vectors.count()
    # A threshold on the hash, a little wide, so that no sort has to hold the sample.
    share = min(1.0, 1.1 * rows / total)
    chosen = vectors.where(F.expr(f"pmod(xxhash64(vec_id), 1000000) < {round(share * 1e6)}"))
    sample = chosen.select("vec_id", "v").limit(2 * rows).toArrow().sort_by("vec_id")
    if not sample.num_rows:
        sample = vectors.select("vec_id", "v").limit(rows).toArrow().sort_by("vec_id")
    known = matrix(sample.column("v"))
    wanted = min(total / LIST_SIZE, len(known) / BEHIND)
    lists = Lists(halve(known, 1 << max(0, int(np.log2(max(1, wanted))))))
    lists.ratio = calibrated(lists, known, k)
    return lists


def listed(vectors: DataFrame, sent, kind: str, ratio: float, least: int) -> DataFrame:
    """(list, vec_id, v) of every list of each vector: its homes, or those it looks into."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        lists: Lists = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                known = matrix(part.column(1))
                if kind == "homes":
                    found = list(lists.homes(known))
                else:
                    found = list(lists.probes(known, ratio, least))
                rows, names = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
                arrays = [names, part.column(0).take(rows), part.column(1).take(rows)]
                yield pa.RecordBatch.from_arrays(arrays, ["list", "vec_id", "v"])

    return in_tasks(vectors, run, "list long, vec_id long, v array<double>")


def best_of(k: int):
    """The k nearest ids of a part for each of its queries, at the smallest distance of their rows."""

    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            vectors = vectors.sort_values("vec_id", kind="stable")
            # Rows of an id lie together, from these places on.
            ids, first = np.unique(vectors["vec_id"].to_numpy(), return_index=True)
            known = np.stack(vectors["v"].to_list())
            size = max(1, (1 << 22) // known.size)
            asked = np.stack(queries["v"].to_list())
            names = queries["vec_id"].to_numpy()
            for at in range(0, len(asked), size):
                gaps = asked[at : at + size, None, :] - known[None, :, :]
                distance = np.sqrt((gaps**2).sum(axis=2))
                distance = np.minimum.reduceat(distance, first, axis=1)
                for name, row in zip(names[at : at + size], distance, strict=True):
                    row = np.where(ids == name, np.inf, row)
                    limit = np.partition(row, min(k, len(row)) - 1)[min(k, len(row)) - 1]
                    near = np.flatnonzero((row <= limit) & np.isfinite(row))
                    near = near[np.lexsort((ids[near], row[near]))][:k]
                    out += [(int(name), int(ids[i]), float(row[i])) for i in near]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def neighbours(
    vectors: DataFrame, queries: F.Column, k: int = 10, ratio: float | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors found for each query, nearest first.

    `vectors` has vec_id and embedding; `queries` says which of its rows are queries. Score is the
    Euclidean distance; ties go to the smaller vec_id; a query's own id is no candidate. Rows without
    vec_id, and vectors that are null, zero, hold a null or non-finite component or are not of the most
    common length, take no part. Rows that share an id count as one candidate at their smallest
    distance. Other columns are ignored; without vectors or queries there are no rows. `ratio` takes the
    place of the calibrated one.
    """
    spark = vectors.sparkSession
    known = usable(vectors)
    scale = scale_of(known)
    if scale != 1:
        # Exact, but for components that vanish beside the largest one.
        known = known.withColumn("v", F.transform("v", lambda x: x / F.lit(scale)))
    lists = fit(known, k)
    if lists is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    homes = stored(listed(known, spark.sparkContext.broadcast(lists), "homes", 0, 0))
    # One row per list.
    lists.sizes = np.zeros(len(lists.centroids), np.int64)
    once = homes.groupBy("vec_id").agg(F.min("list").alias("list"))
    for row in once.groupBy("list").count().collect():
        lists.sizes[row["list"]] = row["count"]
    least = COPIES * (k + 1) + 1
    asked = known.where(queries)
    probes = stored(
        listed(asked, spark.sparkContext.broadcast(lists), "probes", ratio or lists.ratio, least)
    )
    parts = F.expr(f"int(ceil(count / {PART}))")
    cut = homes.groupBy("list").count().select("list", parts.alias("vector_parts"))
    cut = cut.join(
        probes.groupBy("list").count().select("list", parts.alias("query_parts")), "list"
    )
    # As many rows as there are lists, which the sample bounds.
    cut = F.broadcast(stored(cut))
    vector_part = F.expr("int(pmod(xxhash64(vec_id), vector_parts))")
    query_part = F.expr("int(pmod(xxhash64(vec_id), query_parts))")
    every = F.explode(F.expr("sequence(0, query_parts - 1)"))
    left = homes.join(cut, "list").select(
        "list", vector_part.alias("part"), every.alias("block"), "vec_id", "v"
    )
    every = F.explode(F.expr("sequence(0, vector_parts - 1)"))
    right = probes.join(cut, "list").select(
        "list", every.alias("part"), query_part.alias("block"), "vec_id", "v"
    )
    key = ["list", "part", "block"]
    near = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInPandas(best_of(k), "query_id long, vec_id long, score double")
    )
    # A copied vector is found once per list.
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = near.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", (F.col("score") * scale).alias("score"))
