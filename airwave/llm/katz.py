"""Katz backoff n-gram scores of whole texts, learned from the documents themselves.

Counts are discounted by Good-Turing, order by order; what a history loses goes to the words not seen after
it, in proportion to what the history without its first word gives them, with a weight that makes each
history's probabilities sum to one:

    P(w | h) = d(c(h, w)) c(h, w) / c(h)          if (h, w) occurs in training
             = alpha(h) P(w | h without its first word)      otherwise
    P(w)     = d(c(w)) c(w) / N, and what is left for the one unknown word

A history starts at most at the begin of its text, which is a word of its own there.

Tables are partitioned, never gathered. Documents travel in chunks of about half a million tokens, as
compressed arrays:

1. Words, by hash range: each chunk sends its distinct words with counts; a range adds them up, numbers
   its words by falling frequency, and answers each chunk with the numbers of its words. A number gives
   its word's count through a table of frequency steps, whose size is the number of distinct counts.
2. N-grams, by history, for each order from 2 on: a chunk sends each distinct n-gram, with its training count
   in the chunk, to its history's bucket. An n-gram of any frequency so takes one place per chunk. A
   frequent history is spread over buckets by the last word too, and the buckets' shares of it are added up.
3. A bucket adds up its part of the order's table and answers each chunk with the counts of its n-grams and
   histories and, where training has no such n-gram, with what the backoff weight is made of. So the n-grams
   travel once: discounts, and totals of histories that are spread, are known when the chunks read the answers.
   There are four spread histories per bucket at most, which are broadcast. A bucket numbers its n-grams: these
   numbers are the histories of the next order, so the recursion goes on in the same way. A token whose
   history does not occur in training has its score and takes no part in longer orders.
4. Buckets are stored, and asked, in a few parts, so that no more than one part is on disk twice; a part goes
   when it has answered.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.llm.common import Batches, in_tasks
from airwave.llm.language import remainder
from airwave.llm.shingles import hash_words, mix
from airwave.session import new_place, removed, scratch, stored

#: Tokens of a chunk and of a bucket, bytes of text per range of words, longest n-grams, discounted counts.
CHUNK = 1 << 19
BUCKET = 3 << 19
RANGE = 1 << 24
ORDER = 3
DISCOUNTED = 5
#: In how many parts the buckets of an order are asked.
PARTS = 4
#: The end of a text as a word, and the number of the begin as a history.
END = np.uint64(0x5EED0FE2D1CE5EED)
BEGIN = 0

#: Marks a history that is spread over buckets; numbers of n-grams are bucket and rank in it.
SPREAD = 1 << 62
RANK = 32

WORDS = "range int, chunk long, keys binary, counts binary"
ANSWERS = "range int, chunk long, numbers binary, counts binary"
CHUNKS = "chunk long, doc_ids binary, known binary, held_out binary, sizes binary, tokens binary"
STATE = "chunk long, facts binary, tokens binary, numbers binary, places binary, times binary, lower binary"
PARCELS = "heads binary, words binary, counts binary, below binary, out_of binary"
SENT = f"bucket long, {STATE}, {PARCELS}"
TOLD = (
    "chunk long, bucket long, counts binary, sizes binary, ranks binary, rare binary, backed binary, spread binary"
)
CLASSES = (
    "times array<long>, shares array<struct<history: long, times: array<long>, total: long, backed: double>>"
)
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


_COMPRESSOR = zstandard.ZstdCompressor(level=3)


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers, byte plane by byte plane, compressed."""
    width = 4 if not len(values) or int(values.max()) < 1 << 32 else 8
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + _COMPRESSOR.compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel().astype(np.int64)


def discounts(times: list[int]) -> np.ndarray:
    """d(0..k+1) from n(1..k+1), how many items occur so often; index k+1 stands for all above k.

    The plain classes give proper discounts where they fall steadily. Where copies in the corpus bend
    them, they are smoothed by a straight line through log n over log r, the simple form of Good-Turing;
    where there are too few classes for that, half an occurrence is taken off each item.
    """
    k = DISCOUNTED
    r = np.arange(1, k + 2)
    plain = np.array(times, float)
    found = plain > 0
    classes = [plain]
    if found.sum() > 1:
        slope, start = np.polyfit(np.log(r[found]), np.log(plain[found]), 1)
        classes.append(np.exp(start + slope * np.log(r)))
    d = np.ones(k + 2)
    for n in classes:
        with np.errstate(divide="ignore", invalid="ignore"):
            cut = (k + 1) * n[k] / n[0]
            d[1 : k + 1] = (r[1:] * n[1:] / n[:k] / r[:k] - cut) / (1 - cut)
        if np.isfinite(d).all() and (d[1 : k + 1] > 0).all() and (d[1 : k + 1] < 1).all():
            return d
    d[1 : k + 1] = 1 - 0.5 / r[:k]
    return d


@dataclass
class Unigrams:
    """Counts of word numbers, by frequency steps of each range, and their probabilities."""

    ranges: int
    places: np.ndarray
    counts: np.ndarray
    total: int
    types: int
    texts: int
    discount: np.ndarray
    unknown: float

    @classmethod
    def of(cls, steps: list[tuple[int, np.ndarray, np.ndarray]], ranges: int, texts: int):
        """From (range, counts falling, words of that count) of each range."""
        places, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        times = np.zeros(DISCOUNTED + 2, np.int64)
        total = types = 0
        for number, falling, words in steps:
            first = np.concatenate(([0], np.cumsum(words)[:-1]))
            places.append((number << 40) + first)
            counts.append(falling)
            total += int((falling * words).sum())
            types += int(words[falling > 0].sum())
            times += np.bincount(
                np.minimum(falling, DISCOUNTED + 2), words, DISCOUNTED + 3
            ).astype(np.int64)[: DISCOUNTED + 2]
        d = discounts(times[1:].tolist())
        made = cls(
            ranges, np.concatenate(places), np.concatenate(counts), total, types, texts, d, 1.0
        )
        if total:
            values = [f * d[np.minimum(f, DISCOUNTED + 1)] * w for _, f, w in steps]
            made.unknown = 1 - float(np.concatenate(values).sum()) / total
            if made.unknown <= 1e-12:
                # No class is discounted, so the unknown word is given one occurrence.
                made.unknown = 1 / (total + 1)
                made.discount = d * total / (total + 1)
        return made

    def count(self, numbers: np.ndarray) -> np.ndarray:
        """Training counts of word numbers."""
        key = (((numbers - 1) % self.ranges) << 40) + (numbers - 1) // self.ranges
        return self.counts[np.searchsorted(self.places, key, side="right") - 1]

    def probability(self, numbers: np.ndarray) -> np.ndarray:
        c = self.count(numbers)
        seen = c * self.discount[np.minimum(c, DISCOUNTED + 1)] / max(1, self.total)
        return np.where(c > 0, seen, self.unknown)

    def history_count(self, numbers: np.ndarray) -> np.ndarray:
        """How often a number is followed by a word: the begin by the first word of each text."""
        return np.where(numbers == BEGIN, self.texts, self.count(np.maximum(numbers, 1)))


def in_chunks(batches: Batches) -> Iterator[tuple[int, list, list, np.ndarray, np.ndarray]]:
    """(chunk, doc_ids, held_out, sizes, hashes): tokens of some documents one after the other.

    Chunks are numbered by task, so that the same table read in the same way gives the same chunks.
    """
    chunk = TaskContext.get().partitionId() << 32
    ids, held, sizes, tokens, size = [], [], [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            data = [text.encode("utf-8", "replace") for text in part.column(1).to_pylist()]
            hashes, places = hash_words(b"\n".join(data))
            bounds = np.searchsorted(places, np.cumsum([len(d) + 1 for d in data]))
            # Each text's end is inserted behind its last word.
            tokens.append(np.insert(hashes, bounds, END))
            counts = np.diff(bounds, prepend=0) + 1
            ids += part.column(0).to_pylist()
            held += part.column(2).to_pylist()
            sizes += counts.tolist()
            size += int(counts.sum())
            if size >= CHUNK:
                yield chunk, ids, held, np.array(sizes), np.concatenate(tokens)
                chunk += 1
                ids, held, sizes, tokens, size = [], [], [], [], 0
    if ids:
        yield chunk, ids, held, np.array(sizes), np.concatenate(tokens)


def batch_of(names: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in names.split(", ")]
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def number_words(docs: DataFrame, ranges: int) -> DataFrame:
    """Answers (range, chunk, numbers), and per range, with no chunk, its frequency steps."""
    high = ranges.bit_length() - 1

    def words(batches: Batches) -> Iterator[pa.RecordBatch]:
        for chunk, _, held, sizes, tokens in in_chunks(batches):
            keys, at = np.unique(tokens, return_inverse=True)
            learned = np.repeat(~np.array(held), sizes)
            counts = np.bincount(at, learned, len(keys)).astype(np.int64)
            bounds = np.searchsorted(keys >> np.uint64(64 - high), np.arange(1, ranges))
            rows = [
                (r, chunk, packed(np.diff(k, prepend=np.uint64(0))), packed(c))
                for r, (k, c) in enumerate(
                    zip(np.split(keys, bounds), np.split(counts, bounds), strict=True)
                )
                if len(k)
            ]
            yield batch_of(WORDS, rows)

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        number = int(rows["range"].iloc[0])
        # Differences of unsigned numbers, read back as such.
        sent = [np.cumsum(unpacked(k).view(np.uint64), dtype=np.uint64) for k in rows["keys"]]
        keys, at = np.unique(np.concatenate(sent), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, at, np.concatenate([unpacked(c) for c in rows["counts"]]))
        rank = np.empty(len(keys), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(keys))
        numbers = rank * ranges + number + 1
        parts = np.split(numbers[at], np.cumsum([len(s) for s in sent])[:-1])
        values, words = np.unique(counts, return_counts=True)
        out = [(number, c, packed(p), None) for c, p in zip(rows["chunk"], parts, strict=True)]
        out.append((number, -1, packed(words[::-1]), packed(values[::-1])))
        return pd.DataFrame(out, columns=["range", "chunk", "numbers", "counts"])

    return in_tasks(docs, words, WORDS).groupBy("range").applyInPandas(answer, ANSWERS)


def chunk_tokens(docs: DataFrame) -> DataFrame:
    """Each chunk's documents, with tokens as places in the chunk's sorted distinct words."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for chunk, ids, held, sizes, tokens in in_chunks(batches):
            _, at = np.unique(tokens, return_inverse=True)
            row = (
                chunk,
                np.array([i or 0 for i in ids], "<i8").tobytes(),
                np.array([i is not None for i in ids], bool).tobytes(),
                np.array(held, bool).tobytes(),
                packed(sizes),
                packed(at),
            )
            yield batch_of(CHUNKS, [row])

    return in_tasks(docs, run, CHUNKS)


def names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def joined(parts: list[np.ndarray], kind: type = np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


def rising(keys: np.ndarray) -> np.ndarray:
    """The places of keys, which are not negative, in rising order of keys."""
    bits = len(keys).bit_length()
    if len(keys) and int(keys.max()) >> (63 - bits):
        return np.argsort(keys)
    # Sorting values is several times faster than sorting places, so each place goes with its key.
    return np.sort(keys << bits | np.arange(len(keys))) & ((1 << bits) - 1)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, a place of each, and each value's number among them."""
    order = rising(keys)
    ranked = keys[order]
    new = np.diff(ranked, prepend=-1) != 0
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], order[new], number


def spread_from(known: Unigrams, buckets: int) -> float:
    """Histories of at least this count are spread over buckets."""
    return max(1.0, (known.total + known.texts) / (4 * buckets))


def seen_chance(discount: np.ndarray, count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """d(c) c / c(h), and 0 where there is no occurrence."""
    return discount[np.minimum(count, DISCOUNTED + 1)] * count / np.maximum(size, 1)


@dataclass
class Ngrams:
    """A chunk's n-grams of one order before they are sent: a value per token, `at` those that take part.

    `head` and `word` are places in `heads` and `numbers`, which rise; `home` is the bucket of each of `heads`,
    `times` its count.
    """

    at: np.ndarray
    head: np.ndarray
    word: np.ndarray
    heads: np.ndarray
    home: np.ndarray
    times: np.ndarray
    numbers: np.ndarray
    learned: np.ndarray
    lower: np.ndarray
    below: np.ndarray | None = None
    out_of: np.ndarray | None = None

    def sorted(self, buckets: int, least: float) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """The distinct n-grams' buckets, their columns, and each token's place among them, 0 for none."""
        t = self.at
        width = len(self.numbers)
        keys, index, place = distinct(self.head[t] * width + self.word[t])
        counts = np.bincount(place, self.learned[t], len(keys)).astype(np.int64)
        local = keys // width
        head, word, bucket = self.heads[local], self.numbers[keys - local * width], self.home[local]
        often = self.times[local] >= least
        mixed = mix(head[often].astype(np.uint64)) + mix(word[often].astype(np.uint64) + np.uint64(1 << 40))
        bucket[often] = (mix(mixed) % np.uint64(buckets)).astype(np.int64)
        head[often] |= SPREAD
        # The n-grams are in order of history and word, and stay so in each bucket, spread ones last.
        # A stable sort of 16 bits takes linear time.
        kind = np.uint16 if buckets <= 1 << 15 else np.int64
        order = np.argsort((bucket * 2 + often).astype(kind), kind="stable")
        columns = [head, word, counts]
        if self.below is not None:
            columns += [self.below[t][index], self.out_of[t][index]]
        sent = np.empty(len(order), np.int64)
        sent[order] = np.arange(1, len(order) + 1)
        places = np.zeros(len(self.word), np.int64)
        places[t] = sent[place]
        return bucket[order], [c[order] for c in columns], places

    def rows(self, chunk: int, facts: pa.Table, buckets: int, least: float, last: bool) -> pd.DataFrame:
        """The parcels by bucket, and without a bucket what the chunk keeps.

        Bigrams that are not the last order are found again from the chunk's words. The last order keeps, n-gram
        by n-gram, the documents that have it.
        """
        bucket, columns, places = self.sorted(buckets, least)
        found, starts = np.unique(bucket, return_index=True)
        parcels = []
        for i, b in enumerate(found.tolist()):
            part = slice(starts[i], starts[i + 1] if i + 1 < len(starts) else None)
            head, word, counts, *below = (c[part] for c in columns)
            step = np.diff(head, prepend=0)
            if below:
                # What the history without its first word counts is said once per history.
                below[1] = below[1][np.diff(head, prepend=-1) > 0]
            parcel = [packed(step), packed(word), packed(counts), *map(packed, below)]
            parcels.append((b, chunk, *[None] * 6, *parcel, *[None] * (5 - len(parcel))))
        if self.below is None and not last:
            return pd.DataFrame(parcels, columns=names(SENT))
        stream = pa.BufferOutputStream()
        with pa.ipc.new_stream(stream, facts.schema) as writer:
            writer.write_table(facts)
        t = self.at
        if last:
            t = t[rising(places[t])]
            owner = np.repeat(np.arange(facts.num_rows), facts["n_tokens"].to_numpy())
            times = np.bincount(places[t] - 1, minlength=len(bucket)).astype(np.int64)
            kept = [None, None, packed(owner[t]), packed(times)]
        else:
            kept = [packed(self.word), packed(self.numbers), packed(places), None]
        lower = self.lower[t][~self.learned[t]].astype("<f8").tobytes()
        parcels.append((None, chunk, stream.getvalue().to_pybytes(), *kept, lower, *[None] * 5))
        return pd.DataFrame(parcels, columns=names(SENT))


def bigrams(docs: pd.DataFrame, told: pd.DataFrame, known: Unigrams, buckets: int) -> tuple[Ngrams, pa.Table]:
    """A chunk's bigrams, and what is known of its documents."""
    row = docs.iloc[0]
    at = unpacked(row["tokens"])
    numbers = joined([unpacked(n) for n in told.sort_values("range")["numbers"]])
    if len(docs) > 1 or len(numbers) != at.max() + 1:
        raise RuntimeError("the documents were not read twice in the same way")
    # From here on the words are places in their rising numbers.
    order = np.argsort(numbers)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    at, numbers = rank[at], numbers[order]
    counts = known.count(numbers)
    sizes = unpacked(row["sizes"])
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    floor = known.total + 0.1 * (known.types + 1)
    held = np.frombuffer(row["held_out"], bool)
    facts = pa.table(
        {
            "doc_id": pa.array(
                np.frombuffer(row["doc_ids"], "<i8"), mask=~np.frombuffer(row["known"], bool)
            ),
            "held_out": held,
            "n_tokens": sizes,
            "n_known": np.add.reduceat((counts > 0)[at].astype(np.int64), first),
            "base_score": np.add.reduceat(np.log10((counts + 0.1) / floor)[at], first),
            "settled": np.zeros(len(sizes)),
        }
    )
    # The begin as a history stands before the chunk's words.
    before = np.concatenate(([0], at[:-1] + 1))
    before[first] = 0
    heads = np.append(BEGIN, numbers)
    grams = Ngrams(
        at=np.arange(len(at)),
        head=before,
        word=at,
        heads=heads,
        home=(mix(mix(heads.astype(np.uint64))) % np.uint64(buckets)).astype(np.int64),
        times=known.history_count(heads),
        numbers=numbers,
        learned=np.repeat(~held, sizes),
        lower=np.log10(known.probability(numbers))[at],
    )
    return grams, facts


def send_bigrams(
    chunks: DataFrame, answers: DataFrame, sent_unigrams, buckets: int, last: bool
) -> DataFrame:
    """Each chunk's distinct bigrams by bucket, and if they are the last order what the chunk keeps."""

    def run(key: tuple, docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        known: Unigrams = sent_unigrams.value
        if not len(docs):
            return pd.DataFrame([], columns=names(SENT))
        grams, facts = bigrams(docs, told, known, buckets)
        return grams.rows(int(key[0]), facts, buckets, spread_from(known, buckets), last)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, SENT)


@dataclass
class Told:
    """What is known of an order beside its n-grams: discounts, and the totals of its spread histories."""

    discount: np.ndarray
    spread: np.ndarray
    total: np.ndarray
    rare: np.ndarray
    backed: np.ndarray

    @classmethod
    def of(cls, answers: DataFrame) -> Told:
        """From what the buckets say of themselves. A history is spread only where it has a share in tokens."""
        classes = answers.where("chunk IS NULL")
        times = classes.select(F.posexplode("times").alias("r", "n")).groupBy("r").agg(F.sum("n"))
        found = dict(times.collect())
        shares = classes.select(F.inline("shares")).groupBy("history")
        sums = [F.sum(F.col("times")[r]).alias(f"n{r}") for r in range(DISCOUNTED)]
        rows = shares.agg(F.sum("total").alias("total"), F.sum("backed").alias("backed"), *sums)
        rows = rows.orderBy("history").toPandas()
        return cls(
            discounts([found.get(r, 0) for r in range(DISCOUNTED + 1)]),
            rows["history"].to_numpy(np.int64),
            rows["total"].to_numpy(np.int64),
            rows[[f"n{r}" for r in range(DISCOUNTED)]].to_numpy(np.int64),
            rows["backed"].to_numpy(float),
        )

    def weight(self, size: np.ndarray, rare: np.ndarray, backed: np.ndarray) -> np.ndarray:
        """Backoff weights of histories that are so large, whose n-grams that occur r times are `rare[:, r - 1]`.

        A history of which nothing is discounted gives one more occurrence away; one that is not known, all.
        """
        r = np.arange(1, DISCOUNTED + 1)
        left = (rare * ((1 - self.discount[r]) * r)).sum(axis=1)
        return np.where(rare.any(axis=1), left, 1) / size / np.maximum(1 - backed, 1e-300)


def logs_of(told: pd.DataFrame, known: Told) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, counts of the histories, and log10 of probability or backoff weight, of a chunk's n-grams as sent.

    `told` is in the order of its buckets.
    """
    parts = [unpacked(c) for c in told["counts"]]
    counts = joined(parts)
    sizes = joined([unpacked(s) for s in told["sizes"]])
    # A bucket's spread histories come last.
    ends = np.cumsum([len(p) for p in parts])
    some = [(end, np.cumsum(unpacked(s))) for end, s in zip(ends, told["spread"], strict=True) if s]
    at = joined([np.arange(end - len(s), end) for end, s in some])
    of = np.searchsorted(known.spread, joined([s for _, s in some]))
    sizes[at] = known.total[of] + ~known.rare[of].any(axis=1)
    seen = counts > 0
    found = np.zeros(len(counts))
    found[seen] = np.log10(seen_chance(known.discount, counts[seen], sizes[seen]))
    weights = np.zeros(len(counts))
    weights[at] = known.weight(sizes[at], known.rare[of], known.backed[of])
    single = ~seen
    single[at] = False
    rare = joined([unpacked(v) for v in told["rare"] if v]).reshape(-1, DISCOUNTED)
    backed = joined([np.frombuffer(v, "<f8") for v in told["backed"] if v], float)
    weights[single] = known.weight(sizes[single], rare, backed)
    found[~seen] = np.log10(weights[~seen])
    return counts, sizes, found


def facts_of(kept: pd.Series) -> pa.Table:
    return pa.ipc.open_stream(kept["facts"]).read_all()


def lower_of(kept: pd.Series, where: np.ndarray) -> np.ndarray:
    """The order below's log probabilities, which are kept for held-out tokens, at their places."""
    lower = np.zeros(len(where))
    if kept["lower"]:
        lower[where] = np.frombuffer(kept["lower"], "<f8")
    return lower


def longer(
    facts: pa.Table,
    places: np.ndarray,
    lower: np.ndarray,
    words: tuple[np.ndarray, np.ndarray],
    told: pd.DataFrame,
    known: Told,
) -> tuple[Ngrams, pa.Table]:
    """The next order's n-grams, each one of this order and the word after it, and the facts with what is settled.

    A token whose history does not occur in training, or would start before the text, is settled.
    """
    told = told.sort_values("bucket")
    counts, sizes, found = logs_of(told, known)
    ranks = [np.cumsum(unpacked(r)) for r in told["ranks"]]
    home = np.repeat(told["bucket"].to_numpy(np.int64), [len(r) for r in ranks])
    part = places > 0
    logs = np.zeros(len(places))
    logs[part] = found[places[part] - 1]
    backed = part.copy()
    backed[part] = counts[places[part] - 1] == 0
    logs[backed] += lower[backed]
    first = np.concatenate(([0], np.cumsum(facts["n_tokens"].to_numpy())[:-1]))
    head = np.append(0, places[:-1]) - 1
    head[first] = -1
    part &= head >= 0
    part[part] = counts[head[part]] > 0
    settled = facts["settled"].to_numpy() + np.add.reduceat(np.where(part, 0.0, logs), first)
    facts = facts.set_column(facts.schema.get_field_index("settled"), "settled", pa.array(settled))
    at = np.flatnonzero(part)
    below, out_of = np.zeros((2, len(part)), np.int64)
    below[at], out_of[at] = counts[places[at] - 1], sizes[places[at] - 1]
    grams = Ngrams(
        at=at,
        head=head,
        word=words[0],
        heads=(home << RANK) + joined(ranks) + 1,
        home=home,
        times=counts,
        numbers=words[1],
        learned=np.repeat(~facts["held_out"].to_numpy(), facts["n_tokens"].to_numpy()),
        lower=logs,
        below=below,
        out_of=out_of,
    )
    return grams, facts


def send_trigrams(
    chunks: DataFrame, answers: DataFrame, told: DataFrame, sent_unigrams, sent_told, buckets: int, last: bool
) -> DataFrame:
    """Each chunk's distinct trigrams: its bigrams are made again, and met with what the buckets told of them."""
    both = answers.unionByName(told, allowMissingColumns=True)

    def run(key: tuple, docs: pd.DataFrame, both: pd.DataFrame) -> pd.DataFrame:
        known: Unigrams = sent_unigrams.value
        if not len(docs):
            return pd.DataFrame([], columns=names(SENT))
        least = spread_from(known, buckets)
        grams, facts = bigrams(docs, both[both["bucket"].isna()], known, buckets)
        places = grams.sorted(buckets, least)[2]
        words = grams.word, grams.numbers
        grams, facts = longer(facts, places, grams.lower, words, both[both["bucket"].notna()], sent_told.value)
        return grams.rows(int(key[0]), facts, buckets, least, last)

    return chunks.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInPandas(run, SENT)


def send_longer(
    state: DataFrame, told: DataFrame, sent_told, buckets: int, least: float, last: bool
) -> DataFrame:
    """Each chunk's distinct n-grams of an order from 4 on."""

    def run(key: tuple, kept: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        kept = kept.iloc[0]
        facts, places = facts_of(kept), unpacked(kept["places"])
        held = np.repeat(facts["held_out"].to_numpy(), facts["n_tokens"].to_numpy())
        words = unpacked(kept["tokens"]), unpacked(kept["numbers"])
        grams, facts = longer(facts, places, lower_of(kept, held & (places > 0)), words, told, sent_told.value)
        return grams.rows(int(key[0]), facts, buckets, least, last)

    return state.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(run, SENT)


@dataclass
class Bucket:
    """The distinct n-grams of a bucket, by history and word, with their training counts."""

    heads: np.ndarray
    first: np.ndarray
    head: np.ndarray
    count: np.ndarray
    at: np.ndarray
    lower: np.ndarray
    lengths: list[int]

    @classmethod
    def of(cls, rows: pd.DataFrame, chance) -> Bucket:
        """From the chunks' parcels; `chance(word, below, out_of)` is the order below's probability."""
        parts = [np.cumsum(unpacked(h)) for h in rows["heads"]]
        heads, head = np.unique(np.concatenate(parts), return_inverse=True)
        word, counts = (np.concatenate([unpacked(v) for v in rows[c]]) for c in ("words", "counts"))
        dense, width = word, int(word.max()) + 1
        if len(heads) * width >= 1 << 62:
            known, dense = np.unique(word, return_inverse=True)
            width = len(known)
        keys, index, at = distinct(head * width + dense)
        count = np.bincount(at, counts, len(keys)).astype(np.int64)
        below = out_of = None
        if rows["below"].iloc[0] is not None:
            below = np.concatenate([unpacked(v) for v in rows["below"]])[index]
            same = [np.cumsum(np.diff(p, prepend=-1) > 0) - 1 for p in parts]
            out_of = [unpacked(v)[of] for v, of in zip(rows["out_of"], same, strict=True)]
            out_of = np.concatenate(out_of)[index]
        lower = np.where(count > 0, chance(word[index], below, out_of), 0.0)
        head = keys // width
        first = np.searchsorted(head, np.arange(len(heads)))
        return cls(heads, first, head, count, at, lower, [len(p) for p in parts])


def below_of(sent_unigrams, discount: np.ndarray | None):
    """The probability in the order below of n-grams that occur in training."""

    def chance(word: np.ndarray, below: np.ndarray, out_of: np.ndarray) -> np.ndarray:
        if discount is None:
            return sent_unigrams.value.probability(word)
        return seen_chance(discount, below, out_of)

    return chance


def answer_chunks(parcels: DataFrame, chance, last: bool) -> DataFrame:
    """For each parcel the counts of its n-grams and histories, what weights of unseen ones are made of, and ranks.

    Without a chunk, per bucket how many n-grams occur once, twice, ..., and its shares of the histories that are
    spread.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = Bucket.of(rows, chance)
        count, head, bucket = found.count, found.head, rows["bucket"].iloc[0]
        total = np.add.reduceat(count, found.first)
        backed = np.add.reduceat(found.lower, found.first)
        # A history of which nothing is discounted gives one more occurrence away.
        size = total + ~np.logical_or.reduceat((count > 0) & (count <= DISCOUNTED), found.first)
        # How many n-grams occur once, twice, ..., of the histories that are asked for it.
        asked = found.heads >= SPREAD
        asked[head[count == 0]] = True
        number = np.cumsum(asked) - 1
        some = asked[head] & (count > 0)
        key = number[head[some]] * (DISCOUNTED + 2) + np.minimum(count[some], DISCOUNTED + 2) - 1
        rare = np.bincount(key, minlength=int(asked.sum()) * (DISCOUNTED + 2)).reshape(-1, DISCOUNTED + 2)[:, :-1]
        out, start = [], 0
        for chunk, length in zip(rows["chunk"], found.lengths, strict=True):
            at = found.at[start : start + length]
            start += length
            of = head[at]
            often = found.heads[of] >= SPREAD
            unseen = of[(count[at] == 0) & ~often]
            spread = found.heads[of[often]]
            out.append(
                (
                    chunk,
                    bucket,
                    packed(count[at]),
                    packed(size[of]),
                    None if last else packed(np.diff(at, prepend=0)),
                    packed(rare[number[unseen], :DISCOUNTED].ravel()) if len(unseen) else None,
                    backed[unseen].astype("<f8").tobytes() if len(unseen) else None,
                    packed(np.diff(spread, prepend=0)) if len(spread) else None,
                    None,
                    None,
                )
            )
        shares = [
            {
                "history": int(found.heads[i]),
                "times": rare[number[i]].tolist(),
                "total": int(total[i]),
                "backed": float(backed[i]),
            }
            for i in np.flatnonzero(found.heads >= SPREAD)
        ]
        times = np.bincount(np.minimum(count, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1:-1].tolist()
        out.append((None, bucket, *[None] * 6, times, shares))
        made = pd.DataFrame(out, columns=[*names(TOLD), "times", "shares"])
        return made.astype({"chunk": "Int64"})

    return parcels.groupBy("bucket").applyInPandas(run, f"{TOLD}, {CLASSES}")


def gather(state: DataFrame, told: DataFrame, sent_told, train_tokens: int) -> DataFrame:
    """One row per document from what its chunk kept and what the buckets told of the last order."""

    def run(key: tuple, kept: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        kept = kept.iloc[0]
        facts, owner, times = facts_of(kept), unpacked(kept["places"]), unpacked(kept["times"])
        counts, _, found = logs_of(told.sort_values("bucket"), sent_told.value)
        lower = lower_of(kept, facts["held_out"].to_numpy()[owner])
        logs = np.repeat(found, times) + np.where(np.repeat(counts, times) > 0, 0, lower)
        score = facts["settled"].to_numpy() + np.bincount(owner, logs, facts.num_rows)
        # The integers stay nullable.
        out = facts.drop_columns("settled").to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        return out.assign(train_tokens=train_tokens, score=score)[names(SCORES)]

    return state.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(run, SCORES)


def katz_scores(
    docs: DataFrame, modulus: int = 10, bucket: int = BUCKET, order: int = ORDER
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of `docs`.

    `order` is the length of the longest n-grams, 2 at least. Rows whose crc32(doc_id as text) modulo `modulus`
    is not 0 teach the model; a null doc_id counts as the empty text there, which holds the row out. Null and
    empty texts have the end as their only token; a very long text is one chunk. Repeated rows count and are
    scored each. Other columns are left out; an empty table gives no rows. `docs` is read twice, so it must
    give its rows in the same partitions and order, as files do.
    """
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        (remainder("doc_id", modulus) == 0).alias("held_out"),
    )
    size = given.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.count_if(~F.col("held_out")).alias("texts")
    ).first()
    ranges = 1 << max(4, ((size["bytes"] or 0) // RANGE).bit_length())
    words = ExitStack()
    folder = words.enter_context(scratch(spark))
    with words:
        answers = stored(number_words(given, ranges), folder)
        steps = answers.where("chunk = -1").orderBy("range").collect()
        steps = [(r["range"], unpacked(r["counts"]), unpacked(r["numbers"])) for r in steps]
        known = Unigrams.of(steps, ranges, size["texts"])
        unigrams = spark.sparkContext.broadcast(known)
        buckets = max(16, -(-known.total // bucket))
        least = spread_from(known, buckets)
        answers = answers.where("chunk >= 0").drop("counts")
        drop_exchanges(spark)
        place, folder = next_folder(spark, order == 2)
        bigram_rows = send_bigrams(chunk_tokens(given), answers, unigrams, buckets, order == 2)
        sent = in_parts(bigram_rows, folder)
        below = None
        for n in range(2, order):
            kept, folder = next_folder(spark, False)
            with kept:
                told, known_of = ask_buckets(spark, sent, unigrams, below, False, folder)
                below = known_of.value.discount
                if n == 2:
                    # Nothing of this order's table is needed any more.
                    place.close()
                drop_exchanges(spark)
                after, folder = next_folder(spark, n + 1 == order)
                if n == 2:
                    longer_ones = send_trigrams(
                        chunk_tokens(given), answers, told, unigrams, known_of, buckets, order == 3
                    )
                else:
                    state = state_of(spark, sent)
                    longer_ones = send_longer(state, told, known_of, buckets, least, n + 1 == order)
                sent = in_parts(longer_ones, folder)
            place.close()
            place = after
    drop_exchanges(spark)
    told, known_of = ask_buckets(spark, sent, unigrams, below, True)
    return gather(state_of(spark, sent), told, known_of, known.total)


def in_parts(sent: DataFrame, folder: str | None) -> str:
    """Where the rows are stored, the buckets in parts and what the chunks keep apart from them."""
    place = new_place(sent.sparkSession, folder)
    part = F.coalesce(F.col("bucket") % PARTS, F.lit(PARTS)).cast("int")
    sent.withColumn("part", part).write.partitionBy("part").parquet(place)
    return place


def parts_of(spark: SparkSession, sent: str) -> DataFrame:
    return spark.read.schema(f"{SENT}, part int").parquet(sent)


def state_of(spark: SparkSession, sent: str) -> DataFrame:
    return parts_of(spark, sent).where(F.col("part") == PARTS).select(*names(STATE))


def ask_buckets(
    spark: SparkSession, sent: str, sent_unigrams, below: np.ndarray | None, last: bool, folder: str | None = None
) -> tuple[DataFrame, Broadcast[Told]]:
    """What the buckets tell of an order's n-grams, stored, and of the order; `below` are discounts of the one below.

    An order's n-grams are asked once, and are gone then.
    """
    parcels = parts_of(spark, sent).where(F.col("part") < PARTS).select("part", "bucket", "chunk", *names(PARCELS))
    told = count_classes(parcels, sent, below_of(sent_unigrams, below), last, folder)
    found = spark.sparkContext.broadcast(Told.of(told))
    return told.where("chunk IS NOT NULL").drop("times", "shares"), found


def count_classes(parcels: DataFrame, sent: str, chance, last: bool, folder: str | None) -> DataFrame:
    """The buckets' answers and classes, stored part by part; the parcels of a part are removed from `sent` then."""
    spark = parcels.sparkSession
    answers = []
    for part in range(PARTS):
        some = parcels.where(F.col("part") == part).drop("part")
        answers.append(stored(answer_chunks(some, chance, last), folder))
        removed(spark, f"{sent}/part={part}")
        drop_exchanges(spark)
    return reduce(DataFrame.unionAll, answers)


def drop_exchanges(spark: SparkSession) -> None:
    """Let Spark's cleaner find the exchanges of the steps that are done, whose files it removes."""
    spark.sparkContext._jvm.System.gc()


def next_folder(spark: SparkSession, last: bool) -> tuple[ExitStack, str | None]:
    """A folder that goes when its order is done; the last order's table is read by the result, and stays."""
    stack = ExitStack()
    return stack, None if last else stack.enter_context(scratch(spark))
