"""Phrase collocations, counted order by order over sorted count streams.

The corpus is cut into chunks, in which words are small integers. Order by order, each chunk counts its own
n-grams by sorting, and sends them, packed, to buckets; a bucket sorts and adds up what came from all chunks,
numbers the n-grams that occur often enough, and tells each chunk which of its own these are. The chunk then
counts the next order: an n-gram of order n is a pair of adjacent, overlapping ones of order n - 1. What is rare in
one order can't be part of a frequent n-gram of the next, so nothing is lost, and only frequent n-grams are ever
spelled out.

The frequent n-grams of an order are kept as two count streams: sorted by the number of their beginning, in prefix
order, and by that of their ending, in suffix order. Merge joins run through a stream and the order below in
lockstep: in prefix order that gives the counts of all beginnings, in suffix order those of all endings, and the
largest count among the children of a phrase in either stream is that of its best extension.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from contextlib import ExitStack
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.llm.common import in_tasks, ship
from airwave.session import scratch, stored

#: Bytes of text of a chunk, and of text per bucket; a chunk or a bucket is what a task holds at once.
CHUNK, BUCKET = 16 << 20, 16 << 20
#: Buckets of a small corpus, so that all cores have some.
FEWEST = 48
#: Bytes whose words are cut at once, so that few words exist as objects.
SLICE = 1 << 20
#: Words of the longest phrase, least occurrences, rows per language.
LONGEST, LEAST, TOP = 4, 30, 2000
#: A phrase goes if a longer one holds it in this share (of 100) of its occurrences.
SHARE = 80
SCALE = 2_000_000
#: Parts in which the best phrases of a language are found before they are compared as one list.
PARTS = 32
#: Stands between pieces; no byte of UTF-8 text.
EDGE = b"\xff"
#: Bytes of texts: A-Z to lower case, all ends of pieces to a line feed, tab to space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c
    for c in range(256)
)

#: A chunk's sequence, or what it sends to a bucket. Numbers of words (`locals`), of pairs from `start` on.
WORDS = "chunk long, seq binary, bucket int, lang string, words array<string>, locals binary, counts binary, total long"
PAIRS = "chunk long, seq binary, bucket int, start int, left binary, right binary, counts binary"
#: A bucket's frequent n-grams, or the numbers of those that a chunk has.
FOUND_WORDS = "id long, lang string, word string, a long, chunk long, locals binary, ids binary"
FOUND_PAIRS = "id long, left long, right long, a long, chunk long, locals binary, ids binary"
KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<string>": pa.list_(pa.string()),
}


def _rows(schema: str, length: int, **columns: list | np.ndarray) -> pa.RecordBatch:
    """A batch with these columns; the others are null."""
    fields = [part.split() for part in schema.split(", ")]
    arrays = [
        pa.array(columns[name], KINDS[kind]) if name in columns else pa.nulls(length, KINDS[kind])
        for name, kind in fields
    ]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _table(batches: list[pa.RecordBatch], schema: str) -> pa.Table:
    fields = [part.split() for part in schema.split(", ")]
    return pa.Table.from_batches(batches, pa.schema([(name, KINDS[kind]) for name, kind in fields]))


def pack(numbers: np.ndarray) -> bytes:
    """Integers compressed, bytes of one weight together."""
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return planes.reshape(size, -1).T.copy().view(kind).ravel()


def _cut(data: bytes) -> Iterator[bytes]:
    """Folded text in parts of about SLICE bytes that end where pieces end."""
    start = 0
    while len(data) - start > SLICE:
        end = data.find(b"\n", start + SLICE)
        if end < 0:
            break
        yield data[start:end]
        start = end + 1
    yield data[start:]


class _Chunk:
    """Words of some texts as numbers, apart by language; -1 between pieces."""

    def __init__(self) -> None:
        self.size = 0
        self.known: dict[str, dict[bytes, int]] = {}
        self.open: dict[str, list[bytes]] = defaultdict(list)
        self.waiting: dict[str, int] = defaultdict(int)
        self.done: dict[str, list[np.ndarray]] = defaultdict(list)

    def add(self, lang: str, data: bytes) -> None:
        self.open[lang].append(data)
        self.size += len(data) + 1
        self.waiting[lang] += len(data) + 1
        if self.waiting[lang] >= SLICE:
            self._number(lang)

    def _number(self, lang: str) -> None:
        words = b"\n".join(self.open.pop(lang)).replace(b"\n", b" " + EDGE + b" ").split(b" ")
        self.waiting[lang] = 0
        known = self.known.setdefault(lang, {EDGE: -1, b"": -2})
        for word in set(words).difference(known):
            known[word] = len(known) - 2
        ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        self.done[lang] += [ids[ids != -2], np.array([-1], np.int32)]

    def rows(self, chunk: int, buckets: int) -> Iterator[pa.RecordBatch]:
        base, parts = 0, []
        for lang in sorted({*self.open, *self.done}):
            if self.open.get(lang):
                self._number(lang)
            ids = np.concatenate(self.done[lang])
            words = [w for w, i in self.known[lang].items() if i >= 0]
            if not words:
                continue
            counts = np.bincount(ids[ids >= 0], minlength=len(words)).astype(np.int64)
            parts.append(np.where(ids >= 0, ids + np.int32(base), np.int32(-1)))
            seed = zlib.crc32(lang.encode())
            dealt = np.fromiter((zlib.crc32(w, seed) % buckets for w in words), np.int64, len(words))
            order = np.argsort(dealt, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(dealt[order])) + 1):
                yield _rows(
                    WORDS,
                    1,
                    chunk=[chunk],
                    bucket=[int(dealt[part[0]])],
                    lang=[lang],
                    words=[[words[i].decode() for i in part]],
                    locals=[pack((part + base).astype(np.int32))],
                    counts=[pack(counts[part])],
                    total=[int(counts[part].sum())],
                )
            base += len(words)
        if parts:
            yield _rows(WORDS, 1, chunk=[chunk], seq=[pack(np.concatenate(parts))])


def cut_words(
    batches: Iterable[pa.RecordBatch], buckets: int, size: int = CHUNK
) -> Iterator[pa.RecordBatch]:
    """Rows of WORDS from (lang, text): per chunk its sequence, and its words by language and bucket."""
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    chunk = _Chunk()
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            data = text.as_buffer().to_pybytes().translate(FOLD)
            for part in _cut(data):
                chunk.add(lang.as_py(), part)
                if chunk.size >= size:
                    yield from chunk.rows(number, buckets)
                    chunk, number = _Chunk(), number + 1
    yield from chunk.rows(number, buckets)


def add_words(bucket: int, rows: pa.Table, least: int) -> pa.Table:
    """Rows of FOUND_WORDS from all that chunks sent to one bucket."""
    sums: dict[tuple[str, str], int] = defaultdict(int)
    sent = []
    names = ("chunk", "lang", "words", "locals", "counts")
    for chunk, lang, words, places, counts in zip(
        *(rows.column(name).to_pylist() for name in names), strict=True
    ):
        sent.append((chunk, lang, words, places))
        for word, count in zip(words, unpack(counts, np.int64).tolist(), strict=True):
            sums[lang, word] += count
    frequent = sorted(key for key, count in sums.items() if count >= least)
    ids = {key: (bucket << 32) + i for i, key in enumerate(frequent)}
    out = [
        _rows(
            FOUND_WORDS,
            len(ids),
            id=list(ids.values()),
            lang=[lang for lang, _ in frequent],
            word=[word for _, word in frequent],
            a=[sums[key] for key in frequent],
        )
    ]
    for chunk, lang, words, places in sent:
        given = np.array([ids.get((lang, word), -1) for word in words], np.int64)
        out += _told(FOUND_WORDS, chunk, unpack(places, np.int32), given)
    return _table(out, FOUND_WORDS)


def add_pairs(bucket: int, rows: pa.Table, least: int) -> pa.Table:
    """Rows of FOUND_PAIRS from all that chunks sent to one bucket."""
    lefts, rights, counts = (
        [unpack(data, np.int64) for data in rows.column(name).to_pylist()]
        for name in ("left", "right", "counts")
    )
    ends = np.cumsum([len(x) for x in rights])
    left, right = np.concatenate([np.cumsum(x) for x in lefts]), np.concatenate(rights)
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.flatnonzero(
        np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))
    )
    sums = np.add.reduceat(np.concatenate(counts)[order], first)
    often = sums >= least
    numbers = np.where(often, np.cumsum(often) - 1 + (bucket << 32), -1)
    out = [
        _rows(
            FOUND_PAIRS,
            int(often.sum()),
            id=numbers[often],
            left=left[first[often]],
            right=right[first[often]],
            a=sums[often],
        )
    ]
    given = np.empty(len(order), np.int64)
    given[order] = np.repeat(numbers, np.diff(np.append(first, len(order))))
    starts = rows.column("start").to_pylist()
    for i, (chunk, start) in enumerate(zip(rows.column("chunk").to_pylist(), starts, strict=True)):
        mine = given[ends[i] - len(rights[i]) : ends[i]]
        out += _told(FOUND_PAIRS, chunk, np.arange(start, start + len(mine), dtype=np.int32), mine)
    return _table(out, FOUND_PAIRS)


def _told(schema: str, chunk: int, places: np.ndarray, ids: np.ndarray) -> list[pa.RecordBatch]:
    """What a chunk is told: its own numbers of frequent n-grams, and theirs."""
    often = ids >= 0
    if not often.any():
        return []
    data = {"locals": [pack(places[often])], "ids": [pack(ids[often])]}
    return [_rows(schema, 1, chunk=[chunk], **data)]


def pair_up(
    chunk: int, seq: np.ndarray, places: np.ndarray, ids: np.ndarray, buckets: int, last: bool
) -> list[pa.RecordBatch]:
    """Rows of PAIRS: a chunk's pairs of adjacent frequent n-grams by bucket, and the sequence of them.

    `ids[i]` is the number of the n-gram that `seq` calls `places[i]`. Pairs are numbered by bucket, then by
    what they hold, so that a bucket needs to know the first number only.
    """
    size = int(max(seq.max(initial=-1), places.max(initial=-1))) + 1
    number = np.full(size + 1, -1, np.int64)  # the last place answers for -1
    number[places] = ids
    seq = np.where(number[seq] >= 0, seq, np.int32(-1)).astype(np.int64)
    both = (seq[:-1] >= 0) & (seq[1:] >= 0)
    found, at, counts = np.unique(
        seq[:-1][both] * size + seq[1:][both], return_inverse=True, return_counts=True
    )
    if not len(found):
        return []
    left, right = number[found // size], number[found % size]
    mixed = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    dealt = (mixed >> np.uint64(33)).astype(np.int64) % buckets
    order = np.lexsort((right, left, dealt))
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    left, right, counts, dealt = left[order], right[order], counts[order].astype(np.int64), dealt[order]
    out = []
    edges = np.append(np.flatnonzero(np.append(True, np.diff(dealt))), len(dealt)).tolist()
    for start, end in zip(edges, edges[1:], strict=False):
        out.append(
            _rows(
                PAIRS,
                1,
                chunk=[chunk],
                bucket=[int(dealt[start])],
                start=[start],
                left=[pack(np.diff(left[start:end], prepend=0))],
                right=[pack(right[start:end])],
                counts=[pack(counts[start:end])],
            )
        )
    if not last:
        pairs = np.full(len(both), -1, np.int32)
        pairs[both] = place[at]
        # One gap is as good as many.
        pairs = pairs[(pairs >= 0) | np.append(True, pairs[:-1] >= 0)]
        out.append(_rows(PAIRS, 1, chunk=[chunk], seq=[pack(pairs)]))
    return out


def _added(sent: DataFrame, least: int, pairs: bool) -> DataFrame:
    ship(sent.sparkSession)
    add, schema = (add_pairs, FOUND_PAIRS) if pairs else (add_words, FOUND_WORDS)

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        return add(key[0].as_py(), rows, least)

    return sent.where("bucket IS NOT NULL").drop("seq").groupBy("bucket").applyInArrow(run, schema)


def _next_order(sent: DataFrame, found: DataFrame, buckets: int, last: bool) -> DataFrame:
    """Rows of PAIRS from each chunk's sequence and what the buckets told it."""
    ship(sent.sparkSession)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if right.num_rows:
            places, ids = (
                np.concatenate([unpack(data, kind) for data in right.column(name).to_pylist()])
                for name, kind in (("locals", np.int32), ("ids", np.int64))
            )
            for data in left.column("seq").to_pylist():
                seq = unpack(data, np.int32)
                out += pair_up(key[0].as_py(), seq, places, ids, buckets, last)
        return _table(out, PAIRS)

    sequences = sent.where("bucket IS NULL").select("chunk", "seq").groupBy("chunk")
    told = found.where("chunk IS NOT NULL").select(F.col("chunk").alias("of"), "locals", "ids")
    return sequences.cogroup(told.groupBy("of")).applyInArrow(run, PAIRS)


def _scores() -> F.Column:
    """The lowest-scoring cut as struct(score, k, l, r): after the first k words, ties to the smallest k."""
    cuts = (
        "transform(heads, (l, i) -> struct("
        f"cast(cast({SCALE} AS decimal(10, 0)) * cast(a AS decimal(20, 0))"
        " div (cast(l AS decimal(20, 0)) + element_at(tails, -1 - i)) AS long) AS score,"
        " i + 1 AS k, l AS l, element_at(tails, -1 - i) AS r))"
    )
    return F.expr(f"array_min({cuts})")


def count_streams(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    chunk: int = CHUNK,
    bucket: int = BUCKET,
) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) and, per order, the frequent n-grams: id, a, lang, phrase, last, heads, tails.

    `a` is an n-gram's count, `last` its last word; `heads` and `tails` hold the counts of its proper
    beginnings and endings, shortest first. Orders above the first also have their parents, left and right.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(FEWEST, -(-size // bucket))
    orders: list[DataFrame] = []
    # What chunks and buckets exchange over one order goes when the next order has been sent.
    with ExitStack() as before:
        folder = before.enter_context(scratch(spark))
        sent = in_tasks(texts, lambda batches: cut_words(batches, buckets, chunk), WORDS)
        sent = stored(sent, folder)
        totals = sent.where("bucket IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("n"))
        totals = stored(totals)
        for n in range(1, longest + 1):
            found = stored(_added(sent, least, n > 1), folder)
            frequent = found.where("id IS NOT NULL")
            orders.append(_first_order(frequent) if n == 1 else _order(frequent, orders[-1], folder))
            if n < longest:
                with ExitStack() as after:
                    folder = after.enter_context(scratch(spark))
                    sent = stored(_next_order(sent, found, buckets, n + 1 == longest), folder)
                    before.close()
                    before.push(after.pop_all())
    return totals, orders


def _first_order(frequent: DataFrame) -> DataFrame:
    none = F.expr("cast(array() AS array<long>)")
    word = F.col("word")
    return stored(
        frequent.select(
            "id", "a", "lang", word.alias("phrase"), word.alias("last"), none.alias("heads"), none.alias("tails")
        )
    )


def _order(frequent: DataFrame, below: DataFrame, folder: str) -> DataFrame:
    """The n-grams of an order with the counts of all their beginnings and endings."""

    def stream(rows: DataFrame, *order: str) -> DataFrame:
        return stored(rows.repartitionByRange(*order).sortWithinPartitions(*order), folder)

    heads = below.select(
        F.col("id").alias("left"),
        "lang",
        F.col("phrase").alias("head"),
        F.concat("heads", F.array("a")).alias("heads"),
    )
    tails = below.select(
        F.col("id").alias("right"), "last", F.concat("tails", F.array("a")).alias("tails")
    )
    prefix = stream(frequent.select("id", "left", "right", "a"), "left", "right")
    begun = prefix.join(heads.hint("merge"), "left")
    suffix = stream(begun, "right", "left")
    ended = suffix.join(tails.hint("merge"), "right")
    phrase = F.concat_ws(" ", "head", "last").alias("phrase")
    return stored(ended.select("id", "a", "lang", phrase, "last", "heads", "tails", "left", "right"))


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    share: int = SHARE,
    chunk: int = CHUNK,
    bucket: int = BUCKET,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to `longest` words.

    Texts are lower-cased (A-Z) and cut into pieces at `[.,;:!?\\x0A-\\x0D]`, pieces at spaces and tabs into words.
    `a` counts a phrase's occurrences inside pieces, overlapping ones too; phrases below `least` do not count.
    `l` and `r` count both sides of its lowest-scoring cut, n all words of the language, and score is
    floor(2000000 a / (l + r)). A phrase goes if one more word gives a phrase with at least `share` percent of its
    occurrences; longer phrases that hold it are no more frequent than such a one. Ranks follow score, count
    (both falling) and the phrase's bytes.

    A null text counts as empty, a null language as `und`; repeated rows count again; doc_id and other columns
    are not read. Texts of any length are cut between pieces; one piece is held whole. An empty table gives no
    rows. `chunk` and `bucket` are bytes of text that a task holds; results do not depend on them.
    """
    totals, orders = count_streams(docs, longest, least, chunk, bucket)
    scored = []
    for i, order in enumerate(orders[1:], 1):
        rows = order
        if i + 1 < len(orders):
            for side in ("left", "right"):
                # The children of a phrase lie together in the stream of that order.
                best = orders[i + 1].groupBy(F.col(side).alias("id")).agg(F.max("a").alias(f"by_{side}"))
                rows = rows.join(best.hint("merge"), "id", "left")
            longer = F.coalesce(F.greatest("by_left", "by_right"), F.lit(0)).cast("decimal(20, 0)")
            rows = rows.where(longer * 100 < F.col("a").cast("decimal(20, 0)") * share)
        scored.append(rows.withColumn("cut", _scores()).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    rows = reduce(DataFrame.unionByName, scored)
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    rank = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= top).drop("rank", "part")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same rows in DuckDB's SQL.
COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
    FROM pieces
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
    FROM cut, (VALUES (1), (2), (3), (4)) AS orders(k)
    WHERE len(w) >= k
), counted AS (
    SELECT lang, k, g, count(*) AS a FROM grams GROUP BY lang, k, g
), totals AS (
    SELECT lang, cast(sum(a) AS bigint) AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT * FROM counted WHERE k > 1 AND a >= 30
), cuts AS (
    SELECT c.lang, c.g, c.a, i, l.a AS l, r.a AS r,
        cast((2000000::hugeint * c.a) // (l.a + r.a) AS bigint) AS score
    FROM candidates c, (VALUES (1), (2), (3)) AS places(i)
    JOIN counted l ON l.lang = c.lang AND l.g = c.g[1:i]
    JOIN counted r ON r.lang = c.lang AND r.g = c.g[i + 1:]
    WHERE i < c.k
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1
), inside AS (
    SELECT DISTINCT p.lang, p.g
    FROM (
        SELECT lang, a, k, m, unnest(list_transform(range(1, k - m + 2), lambda i: g[i:i + m - 1])) AS part
        FROM candidates, (VALUES (2), (3)) AS shorter(m)
        WHERE m < k
    ) longer JOIN candidates p ON p.lang = longer.lang AND p.g = longer.part
    WHERE 100::hugeint * longer.a >= 80::hugeint * p.a
), ranked AS (
    SELECT s.lang, array_to_string(s.g, ' ') AS phrase, s.a, s.l, s.r, s.score
    FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.g = s.g
    WHERE i.g IS NULL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
