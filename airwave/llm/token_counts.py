"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced.

The vocabulary is byte-level BPE over words: white space is dropped and never part of a token, so a
short text is the sum of its words, and each distinct word is encoded once per worker.

A huge text is encoded in chunks that overlap, with offsets. Two neighbours are spliced at a stable
common boundary p: in both encodings a word's last token ends at p and the next token is the same.
Why the count is then exact: words are found from left to right and without looking back, so the scan
of the right chunk from p on is the scan of the whole text from p on; and the left chunk is the whole
text's encoding up to p, as p lies further from its end than any special string is long. The character
at p must be ASCII, since the normaliser never joins one to its predecessor. If the overlap has no such
boundary it is widened; if it has become the whole chunk, the left chunk is enlarged, at last to the
whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from airwave.llm.common import Batches, in_tasks, slices, texts
from airwave.llm.tokens import _PLAIN, WORD_BPE, byte_letters, tokenizer

#: Texts of more characters are spliced from chunks of this size.
CHUNK = 1 << 14
OVERLAP = 256
#: Longer than any special string of the vocabulary.
GUARD = 16
#: Counts of words that one worker keeps, about 120 bytes each.
REMEMBERED = 1_000_000

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Chunk:
    """Tokens of text[start:end]: where they begin and end in the text, ids, and word ends."""

    def __init__(self, library, word_end: np.ndarray, text: str, start: int, end: int):
        one = library.encode(text[start:end], add_special_tokens=False)
        spans = np.array(one.offsets, np.int64).reshape(-1, 2) + start
        self.start, self.end = start, end
        self.begins, self.ends = spans[:, 0], spans[:, 1]
        self.ids = np.array(one.ids, np.int64)
        self.closes = word_end[self.ids]

    def boundaries(self, low: int, high: int) -> dict[int, int]:
        """Place in the text -> number of the token that follows, for word ends in [low, high]."""
        at = np.flatnonzero(
            self.closes[:-1] & (self.ends[:-1] >= low) & (self.ends[:-1] <= high)
        )
        return dict(zip(self.ends[at].tolist(), (at + 1).tolist(), strict=True))


class Splicer:
    """Counts the tokens of texts of any length with one vocabulary."""

    def __init__(self, name: str = WORD_BPE, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.library = tokenizer(name)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.word_end[i] = token.endswith("</w>")
        self.chunk, self.overlap = chunk, overlap

    def common(self, text: str, left: Chunk, right: Chunk, after: int) -> tuple[int, int] | None:
        """Numbers of the tokens that follow the last stable boundary, in `left` and in `right`."""
        low, high = max(after + 1, right.start + 1), left.end - GUARD
        theirs = right.boundaries(low, high)
        ours = left.boundaries(low, high)
        for place in sorted(theirs.keys() & ours.keys(), reverse=True):
            i, j = ours[place], theirs[place]
            same = left.begins[i] == right.begins[j] and left.ids[i] == right.ids[j]
            if same and text[place].isascii():
                return i, j
        return None

    def count(self, text: str) -> int:
        size = len(text)
        left = Chunk(self.library, self.word_end, text, 0, min(size, self.chunk))
        counted = first = spliced = 0
        while left.end < size:
            overlap = self.overlap
            found = None
            while found is None and overlap < left.end - left.start:
                start = left.end - overlap
                end = min(size, start + max(self.chunk, 2 * overlap))
                right = Chunk(self.library, self.word_end, text, start, end)
                found = self.common(text, left, right, spliced)
                overlap *= 2
            if found is None:
                end = min(size, left.end + (left.end - left.start))
                left = Chunk(self.library, self.word_end, text, left.start, end)
                # The larger chunk begins where the smaller one did: its tokens up to the last
                # boundary are unchanged, so the place alone says which are counted already.
                first = int(np.searchsorted(left.begins, spliced)) if spliced else 0
                continue
            last, first_right = found
            counted += last - first
            spliced = int(left.ends[last - 1])
            left, first = right, first_right
        return counted + len(left.ids) - first


class WordCounts:
    """Token counts of short texts from those of their words."""

    def __init__(self, name: str = WORD_BPE, remembered: int = REMEMBERED):
        self.library = tokenizer(name)
        self.splicer = Splicer(name)
        self.remembered = remembered
        self.known: dict[str, int] = {"": 0}
        self.letters = byte_letters()
        self.marks = {m: self._plain(m) for m in ".,;:!?"} | {"": 0}

    def _plain(self, word: str) -> int:
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return len(self.library.model.tokenize(word))

    def _learn(self, new: set[str]) -> None:
        other = []
        for word in new:
            plain = _PLAIN.fullmatch(word)
            if plain is None:
                other.append(word)
            else:
                letters, mark = plain.group(1, 2)
                self.known[word] = self._plain(letters) + self.marks[mark]
        encoded = self.library.encode_batch_fast(other, add_special_tokens=False)
        self.known.update((w, len(one)) for w, one in zip(other, encoded, strict=True))

    def batch(self, values: list[str]) -> list[int]:
        """The count of each text."""
        # Spaces and line feeds are white space in every definition; anything else stays inside.
        cut = [
            text.replace("\n", " ").split(" ") if len(text) <= self.splicer.chunk else None
            for text in values
        ]
        if len(self.known) > self.remembered:
            self.known = {"": 0}
        new: set[str] = set()
        for words in cut:
            if words is not None:
                new.update(words)
        self._learn(new.difference(self.known))
        known = self.known.__getitem__
        return [
            self.splicer.count(text) if words is None else sum(map(known, words))
            for words, text in zip(cut, values, strict=True)
        ]


@lru_cache(maxsize=2)
def word_counts(name: str) -> WordCounts:
    return WordCounts(name)


def count_tokens(docs: DataFrame, vocabulary: str = WORD_BPE, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of `docs` (doc_id, text, ...).

    A null text counts as empty: no bytes, no tokens. Repeated rows and null doc_ids give a row each,
    other columns are left out, an empty table gives no rows. Special strings inside a text count as
    the library counts them by default.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        counter = word_counts(vocabulary)
        for doc_ids, values in slices(batches):
            counts = counter.batch(values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array([len(v.encode()) for v in values], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return in_tasks(texts(docs), run, SCHEMA)
