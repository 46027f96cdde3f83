"""Language of whole texts: averaged hashed subword embeddings under a linear softmax.

A text becomes its character n-grams of 2 to 4 letters, within words and their edges, hashed into
buckets. The mean of the buckets' embeddings goes through a linear layer and a softmax. Training is
plain stochastic gradient descent in numpy on a bounded sample. As the whole is linear before the
softmax, prediction needs only each bucket's class scores, averaged over all n-grams of the text.

A part of the sample is held back to calibrate: a temperature for the probabilities, the confidence under
which a prediction is rejected, and how unlike the learned languages a text may be. A softmax is sure of
some class whatever it sees, so each class also keeps the log frequencies of its buckets; their mean over a text,
as a deviation from what held-back texts of that class and length have, tells texts of no learned class apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.llm.common import Batches, in_tasks, release_memory, slices, texts

BUCKETS = 1 << 15
DIMENSIONS = 16
#: Labelled rows a language gives to training and calibration.
PER_LANGUAGE = 1000
#: Rows that training visits at least, and times that it visits each.
VISITS = 20_000
EPOCHS = 5
BATCH = 16
RATE = 4.0
#: Share of the calibration rows that may be rejected for their confidence.
REJECTED = 0.001
#: A text may be so much more unlike its class than any calibration row; fewer rows than these tell nothing.
SLACK, CALIBRATION_ROWS = 1.5, 100
UNKNOWN = "und"

SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngrams(text: str) -> np.ndarray:
    """Buckets of the text's n-grams; none if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    if not len(points):
        return np.zeros(0, np.uint16)
    kept = letters()[points]
    if not kept.any():
        return np.zeros(0, np.uint16)
    # One gap between words, one before the first and one after the last.
    padded = np.zeros(len(points) + 2, np.uint32)
    padded[1:-1] = np.where(kept, points, 0)
    gap = padded == 0
    padded = padded[np.append(True, ~(gap[1:] & gap[:-1]))]
    word = padded != 0
    code = padded * np.uint32(0x9E3779B1)
    found = []
    for n, inner in ((2, None), (3, word[1:-1]), (4, word[1:-2] & word[2:-1])):
        if len(code) < n:
            continue
        mixed = code[: len(code) - n + 1].copy()
        for i in range(1, n):
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)
            mixed += code[i : len(code) - n + 1 + i]
        mixed ^= mixed >> np.uint32(13)
        mixed *= np.uint32(0xC2B2AE3D)
        buckets = (mixed >> np.uint32(17)).astype(np.uint16)
        found.append(buckets if inner is None else buckets[inner])
    return np.concatenate(found)


@dataclass
class Model:
    """Class scores and log frequencies of each bucket, and what calibration found.

    `least` is the smallest accepted confidence. `usual` is the mean log frequency of each class's own texts,
    `spread` its variance per text and per n-gram, and `farthest` the largest accepted deviation.
    """

    names: list[str]
    scores: np.ndarray
    bias: np.ndarray
    frequencies: np.ndarray
    temperature: float = 1.0
    least: float = 0.0
    usual: np.ndarray | None = None
    spread: tuple[float, float] = (1.0, 1.0)
    farthest: float = float("inf")

    def logits(self, shares: np.ndarray) -> np.ndarray:
        return shares @ self.scores + self.bias

    def likeness(self, shares: np.ndarray, at: int) -> float:
        """Mean log frequency of the n-grams in a class."""
        return float(shares @ self.frequencies[:, at])

    def judge(self, grams: np.ndarray) -> tuple[str, float, bool]:
        """Language, its probability, and whether the prediction is rejected."""
        shares = np.bincount(grams, minlength=BUCKETS).astype(np.float32) / np.float32(len(grams))
        chances = softmax(self.logits(shares)[None, :] / self.temperature)[0]
        best = int(chances.argmax())
        score = min(1.0, float(chances[best]))
        rejected = score < self.least
        if self.usual is not None and not rejected:
            off = self.usual[best] - self.likeness(shares, best)
            rejected = off / np.sqrt(self.spread[0] + self.spread[1] / len(grams)) > self.farthest
        return self.names[best], score, bool(rejected)


@dataclass
class Sample:
    """A labelled text: its distinct buckets, their counts and the sum of these."""

    lang: str
    buckets: np.ndarray
    counts: np.ndarray
    size: int

    def shares(self) -> np.ndarray:
        found = np.zeros(BUCKETS, np.float32)
        found[self.buckets] = self.counts / self.size
        return found


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(rows: list[Sample], rejected: float = REJECTED) -> Model | None:
    """A model from labelled texts; none without a text that has n-grams."""
    rows = [row for row in rows if row.size]
    if not rows:
        return None
    names = sorted({row.lang for row in rows})
    place = {name: i for i, name in enumerate(names)}
    rng = np.random.default_rng(7)
    order = rng.permutation(len(rows))
    cut = max(1, len(rows) // 5) if len(rows) > 10 else 0
    held, used = order[:cut], order[cut:]
    embedding = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    epochs = max(EPOCHS, -(-VISITS // len(used)))
    steps = epochs * -(-len(used) // BATCH)
    step = 0
    for _ in range(epochs):
        rng.shuffle(used)
        for at in range(0, len(used), BATCH):
            rate = RATE * (1 - step / steps)
            step += 1
            batch = [rows[i] for i in used[at : at + BATCH]]
            # The share of each bucket in each text; only buckets of this batch have a part in the step.
            flat = np.unique(np.concatenate([row.buckets for row in batch]))
            shares = np.zeros((len(batch), len(flat)), np.float32)
            for share, row in zip(shares, batch, strict=True):
                share[np.searchsorted(flat, row.buckets)] = row.counts / row.size
            mean = shares @ embedding[flat]
            error = softmax(mean @ weights + bias)
            error[np.arange(len(batch)), [place[row.lang] for row in batch]] -= 1
            error = error.astype(np.float32)
            back = error @ weights.T
            weights -= rate * mean.T @ error / len(batch)
            bias -= rate * error.mean(axis=0)
            # Rows of one batch are applied as separate steps, so rare buckets learn too.
            embedding[flat] -= rate * (shares.T @ back)
    seen = np.full((BUCKETS, len(names)), 0.5)
    for row in (rows[i] for i in used):
        seen[row.buckets, place[row.lang]] += row.counts
    frequencies = np.log(seen / seen.sum(axis=0)).astype(np.float32)
    model = Model(names, embedding @ weights, bias, frequencies)
    if cut:
        calibrate(model, [rows[i] for i in held], place, rejected)
    return model


def calibrate(model: Model, rows: list[Sample], place: dict[str, int], rejected: float) -> None:
    """Temperature by likelihood, and the thresholds.

    The confidence threshold loses at most the given share of these rows; the deviation may be SLACK times
    the largest of theirs. With fewer than CALIBRATION_ROWS rows no text is rejected for its deviation.
    """
    logits = np.array([model.logits(row.shares()) for row in rows])
    truth = np.array([place[row.lang] for row in rows])

    def loss(temperature: float) -> float:
        right = softmax(logits / temperature)[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(right, 1e-12)).mean())

    model.temperature = float(min(np.geomspace(0.5, 20, 121), key=loss))
    confidence = softmax(logits / model.temperature).max(axis=1)
    model.least = float(np.quantile(confidence, rejected, method="lower"))
    if len(rows) < CALIBRATION_ROWS:
        return
    likeness = np.array([model.likeness(r.shares(), t) for r, t in zip(rows, truth, strict=True)])
    sizes = np.array([row.size for row in rows])
    usual = np.full(len(model.names), np.average(likeness, weights=np.sqrt(sizes)))
    for t in np.unique(truth):
        own = truth == t
        usual[t] = np.average(likeness[own], weights=np.sqrt(sizes[own]))
    off = usual[truth] - likeness
    # Long texts show how texts differ, short ones how n-grams do.
    by_text = float(np.median(off[sizes >= np.median(sizes)] ** 2)) + 1e-6
    by_gram = float(np.median(off**2 * sizes)) + 1e-6
    deviation = off / np.sqrt(by_text + by_gram / sizes)
    model.usual, model.spread = usual, (by_text, by_gram)
    model.farthest = SLACK * max(3.0, float(deviation.max()))


def remainder(column: str, modulus: int) -> F.Column:
    """crc32 of an id as text, modulo; a null id is the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Train on at most `per_language` rows of each value of lang: those whose ids hash lowest.

    Rows with a null text or lang, or without letters, teach nothing; the others teach with their whole text.
    Of it the driver gets the counts of its buckets, whose number does not grow with the text.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                found = [np.unique(ngrams(t), return_counts=True) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([b.astype("<u2").tobytes() for b, _ in found], pa.binary()),
                        pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary()),
                    ],
                    ["lang", "buckets", "counts"],
                )

    labelled = docs.select(
        F.col("doc_id").alias("id"), F.col("lang").cast("string"), F.col("text").cast("string")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    key = F.xxhash64(F.col("id").cast("string"))
    order = Window.partitionBy("lang").orderBy(key, "id")
    # The ids are chosen on a narrow scan; their texts are then picked by a join on the bounded list.
    chosen = (
        labelled.select("id", "lang")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= per_language)
        .select(F.col("id").alias("chosen_id"), F.col("lang").alias("chosen_lang"))
    )
    same = F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("lang") == F.col("chosen_lang"))
    sample = labelled.join(F.broadcast(chosen), same, "left_semi").select("lang", "text")
    rows = in_tasks(sample, run, "lang string, buckets binary, counts binary").collect()
    # Rows come in no fixed order; training needs one.
    learned = sorted((row["lang"], bytes(row["buckets"]), bytes(row["counts"])) for row in rows)
    samples = []
    for lang, buckets, counts in learned:
        known = np.frombuffer(counts, "<u4")
        samples.append(Sample(lang, np.frombuffer(buckets, "<u2"), known, int(known.sum())))
    del rows, learned
    model = train(samples)
    del samples
    # The driver goes on to other work; what training took goes back to the system.
    release_memory()
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of each row of `docs` (doc_id, text, ...).

    The prediction sees the text alone. A text that is null or has no letter is `und` with score 0 and
    rejected, and so is every text where nothing could be learned. Otherwise lang_pred is the likeliest
    learned language, score its calibrated probability, and rejected says that this lies below the
    threshold or that the text is too unlike that language. Whole texts count, of any length; of equally likely
    languages the first by name is given. Repeated rows and null doc_ids give a row each; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for doc_ids, values in slices(batches):
            rows = []
            for text in values:
                grams = ngrams(text) if known else ()
                if not len(grams):
                    rows.append((UNKNOWN, 0.0, True))
                    continue
                rows.append(known.judge(grams))
            names, scores, rejected = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return in_tasks(texts(docs), run, SCHEMA)


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text the model does not reject."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                kept = []
                for text in part.column(place).to_pylist():
                    grams = ngrams(text or "") if known else ()
                    kept.append(bool(len(grams)) and not known.judge(grams)[2])
                yield part.filter(pa.array(kept))

    return in_tasks(docs, run, docs.schema)
