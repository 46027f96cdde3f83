"""Whitening of embeddings from the exact characteristic polynomial of their integer scatter.

Entries become integers, so their scatter matrix n sum(x x') - S S' is an integer matrix, summed without
rounding. Its characteristic polynomial is worked out modulo many primes, each by reduction to Hessenberg form
in some task, and put together by the Chinese remainder theorem. All its roots are real, so counts of sign
changes isolate them exactly; in one task per root it is refined to 128 binary places, and inverse iteration in
fixed-point arithmetic finds its null space. Rows then are projected where they lie: no step shuffles vectors, and
what reaches the driver depends on their length, not on their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.charpoly import (
    BITS,
    charpoly_mod,
    from_remainders,
    isolated,
    null_vectors,
    primes_for,
    refined,
    scaled,
)
from airwave.llm.common import in_tasks

COMPONENTS = 32
#: An entry c becomes floor(STEP c) + ORIGIN.
STEP, ORIGIN = 64, 1_000_000
#: Integers from larger entries stand at this bound, so that they and their differences fit in 64 bits.
BOUND = 1 << 61
#: Rows that are multiplied at once, and bits of the parts of large entries: products add up exactly in doubles.
ROWS, PART = 4096, 20
#: Bits of the parts in which sums travel; 2^23 tasks may add theirs.
WORD = 40
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """Row count, integer sums less ORIGIN, eigenvalues of the covariance and unit components (as rows)."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    explained: np.ndarray


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(key, vector as doubles) of the rows that take part, and the vectors' length.

    Null vectors and those with null or non-finite entries go. Vectors of different lengths have no common
    covariance: the most frequent length counts, the larger one of equally frequent ones.
    """
    finite = f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    rows = vectors.select(
        F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias(vector)
    ).where(f"{vector} IS NOT NULL AND size({vector}) > 0 AND {finite}")
    lengths = rows.groupBy(F.size(vector).alias("size")).count()
    best = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    size = best["size"] if best else 0
    return rows.where(F.size(vector) == size).withColumnRenamed(vector, "vector"), size


def integers(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and vectors, as integers less ORIGIN, of a few rows at a time."""
    for start in range(0, batch.num_rows, ROWS):
        rows = batch.slice(start, ROWS)
        values = rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        with np.errstate(over="ignore"):
            values = np.clip(np.floor(values * STEP), -BOUND, BOUND)
        yield rows.column(0), values.astype(np.int64)


def _products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers, exactly."""
    parts = []
    while True:
        if not len(y) or max(int(y.max()), -int(y.min())) < 1 << PART:
            parts.append(y.astype(np.float64))
            break
        parts.append((y & ((1 << PART) - 1)).astype(np.float64))
        y = y >> PART
    total = np.zeros((y.shape[1],) * 2, object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total += (a.T @ b).astype(np.int64).astype(object) << (PART * (i + j))
    return total


def scatter_sums(vectors: DataFrame, size: int) -> tuple[int, list[int], np.ndarray]:
    """Row count, sums and sums of products of the integer vectors less ORIGIN, exactly."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1,) * 2, object)
        for batch in batches:
            for _, y in integers(batch, size):
                # A column of ones adds the sums and the count.
                total += _products(np.hstack([np.ones((len(y), 1), np.int64), y]))
        rows = []
        for i in range(size + 1):
            for j in range(i, size + 1):
                value, place = int(total[i, j]), 0
                while not -(1 << WORD) <= value < 1 << WORD:
                    rows.append((i, j, place, value & ((1 << WORD) - 1)))
                    value, place = value >> WORD, place + 1
                rows.append((i, j, place, value))
        names = ["i", "j", "place", "value"]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names)

    sums = in_tasks(vectors, run, "i int, j int, place int, value long")
    total = np.zeros((size + 1,) * 2, object)
    # A few rows for each pair of dimensions.
    for r in sums.groupBy("i", "j", "place").agg(F.sum("value").alias("value")).collect():
        total[r["i"], r["j"]] += r["value"] << (WORD * r["place"])
    for i in range(size + 1):
        total[i + 1 :, i] = total[i, i + 1 :]
    return int(total[0, 0]), [int(v) for v in total[0, 1:]], total[1:, 1:]


def charpoly(vectors: DataFrame, matrix: np.ndarray) -> list[int]:
    """The characteristic polynomial of a positive semidefinite integer matrix, its primes spread over tasks."""
    spark = vectors.sparkSession
    primes = primes_for(matrix)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                remainders = charpoly_mod(matrix, p)
                yield pa.RecordBatch.from_pydict({"p": [p], "remainders": [remainders]})

    given = spark.createDataFrame([(p,) for p in primes], "p long").repartition(
        min(len(primes), spark.sparkContext.defaultParallelism * 2)
    )
    found = in_tasks(given, run, "p long, remainders array<long>").collect()
    return from_remainders({r["p"]: r["remainders"] for r in found})


def fit_whitening(
    vectors: DataFrame, size: int, most: int = COMPONENTS, bits: int = BITS
) -> Whitening:
    """The whitening of rows from `usable`; at most `most` components, those of the largest eigenvalues.

    Eigenvalues that are 0 have no component here. Without rows there is none at all.
    """
    spark = vectors.sparkSession
    none = Whitening(0, [0] * size, np.zeros(0), np.zeros((0, size)), np.zeros(0))
    if size == 0:
        return none
    n, sums, products = scatter_sums(vectors, size)
    if n == 0:
        return none
    matrix = products * n - np.array([[a * b for b in sums] for a in sums], object)
    trace = sum(int(matrix[i, i]) for i in range(size))
    if trace == 0:
        return Whitening(n, sums, *[getattr(none, k) for k in ("eigenvalues", "components", "explained")])
    poly = scaled(charpoly(vectors, matrix), bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, low, high, roots in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                root = refined(poly, int(low), int(high), roots)
                for v in null_vectors(matrix, root, roots, bits):
                    yield pa.RecordBatch.from_pydict(
                        {"number": [number], "root": [str(root)], "vector": [v]},
                        pa.schema(
                            [("number", pa.int32()), ("root", pa.string())]
                            + [("vector", pa.list_(pa.float64()))]
                        ),
                    )

    parts = [(i, str(a), str(b), m) for i, (a, b, m) in enumerate(isolated(poly, most, bits))]
    given = spark.createDataFrame(parts, "number int, low string, high string, roots int")
    found = in_tasks(
        given.repartition(min(len(parts), spark.sparkContext.defaultParallelism)),
        run,
        "number int, root string, vector array<double>",
    )
    # One row per component; a stable sort, so that vectors of one root stay in order.
    rows = sorted(found.collect(), key=lambda r: r["number"])[:most]
    roots = [int(r["root"]) for r in rows]
    return Whitening(
        n,
        sums,
        np.array([r / ((n * n) << bits) for r in roots]),
        np.array([r["vector"] for r in rows]),
        np.array([r / (trace << bits) for r in roots]),
    )


def _centred(y: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """The vectors less their mean as doubles; and, in integers, less the whole part of the mean."""
    whole = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([(s % model.n) / model.n for s in model.sums])
    near = y - whole
    return near - rest, near


def _deviations(near: np.ndarray, model: Whitening) -> list[int | None]:
    """Per row the sum of (n x - S)^2; null where it passes 64 bits."""
    rest = [s % model.n for s in model.sums]
    most = model.n * (int(np.abs(near).max(initial=0)) + 1)
    if most * most * max(1, near.shape[1]) <= LONG:
        off = near * model.n - np.array(rest, np.int64)
        return (off * off).sum(axis=1).tolist()
    off = near.astype(object) * model.n - np.array(rest, object)
    return [int(v) if v <= LONG else None for v in (off * off).sum(axis=1)]


def _projected(y: np.ndarray, model: Whitening) -> np.ndarray:
    centred, _ = _centred(y, model)
    return (centred @ model.components.T) / np.sqrt(model.eigenvalues)


def identity_error(vectors: DataFrame, size: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, measured over all rows."""
    k = len(model.eigenvalues)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for _, y in integers(batch, size):
                rows = np.hstack([np.ones((len(y), 1)), _projected(y, model)])
                total += rows.T @ rows
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_pydict(
            {"i": i.astype(np.int32), "j": j.astype(np.int32), "value": total[i, j]}
        )

    sums = in_tasks(vectors, run, "i int, j int, value double").groupBy("i", "j")
    total = np.zeros((k + 1, k + 1))
    for r in sums.agg(F.sum("value").alias("value")).collect():
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["value"]
    mean = total[0, 1:] / model.n
    covariance = total[1:, 1:] / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def whiten(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    most: int = COMPONENTS,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    Each entry c counts as floor(64 c) + 1000000, at most 2^61 away from that origin. Components are unit
    eigenvectors of the covariance over all rows that take part (`usable`), numbered from 1 by falling
    eigenvalue; those of eigenvalue 0 are left out, and equal eigenvalues share their space in some orthonormal
    basis. `deviation` is the sum over dimensions of (n x - S)^2, exact; null where it passes 64 bits.
    `identity_error` is measured over all whitened rows. A null key stays null; repeated rows count again. An
    empty table, one row, or equal rows give no rows.
    """
    rows, size = usable(vectors, key, vector)
    model = fit_whitening(rows, size, most)
    k = len(model.eigenvalues)
    error = identity_error(rows, size, model) if k else 0.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, y in integers(batch, size) if k else ():
                m = len(keys)
                _, near = _centred(y, model)
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(_deviations(near, model), pa.int64()).take(pa.array(each)),
                        pa.array(_projected(y, model).ravel()),
                        pa.array(np.tile(model.explained, m)),
                    ],
                    ["vec_id", "component", "deviation", "whitened", "explained"],
                )

    schema = "vec_id long, component int, deviation long, whitened double, explained double"
    return in_tasks(rows, run, schema).select(
        "vec_id",
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
    )
