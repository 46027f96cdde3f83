"""Exact token ids of whole texts, with the ids of repeated words remembered per worker.

A space that follows a character other than white space always begins a new pre-token of the
byte-level pattern (` ?letters`, ` ?digits`, ` ?others`, `white space`), so a text may be cut before
such spaces and the parts encoded on their own. Added tokens hold no space. Most parts are words that
occur again and again; each is encoded once and its ids are kept until a limit in bytes is reached.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from airwave.llm.common import forget_between

#: Bytes that known parts may take in a Python worker, and about what each takes beside its text and ids.
REMEMBERED, OVERHEAD = 96 << 20, 170
#: Name by which tasks keep the encoder.
BYTE_IDS = "byte ids"
#: A huge text is encoded in stretches of about this many characters.
STRETCH = 1 << 18

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

# White space of any definition, so that a doubtful character never allows a cut after it.
_SPACES = "\\s\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff"
_CUT = re.compile(f"(?<=[^{_SPACES}]) ")
_EDGE = re.compile(f"[^{_SPACES}] ")
_ASCII_DOUBTS = ("  ", "\n ", "\r ", "\t ", "\x0b ", "\x0c ", "\x1c ", "\x1d ", "\x1e ", "\x1f ")
_OTHER_DOUBTS = "\x85\xa0\u1680\u180e\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(
    map(chr, range(0x2000, 0x2010))
)
# A run of letters with at most one mark after it, perhaps twice with a line feed between: one
# pre-token each, in either pattern.
MARKS = ".,;:!?"
LETTERS = {c for c in map(chr, range(65, 256)) if re.match("[A-Za-zÀ-ÖØ-öø-ÿ]", c)}
_LETTERS = f"([A-Za-zÀ-ÖØ-öø-ÿ]+)([{MARKS}]?)"
_PLAIN = re.compile(f"{_LETTERS}(?:\n{_LETTERS})?")


def vocabulary_path(name: str) -> str:
    """A file of that path, or else the installed public file of that name."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(name: str):
    """The library's tokenizer, without truncation or padding; one per worker and vocabulary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(vocabulary_path(name))
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others from U+0100 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in pieces of about `size` characters, cut only where encoding cannot notice."""
    start = 0
    while len(text) - start > size:
        edge = _EDGE.search(text, start + size)
        if edge is None:
            break
        yield text[start : edge.start() + 1]
        start = edge.start() + 1
    yield text[start:] if start else text


def parts(text: str) -> list[str]:
    """The text cut at safe spaces; all but the first part have lost their leading space."""
    if text[:1] == " " or any(x in text for x in _ASCII_DOUBTS):
        return _CUT.split(text)
    if not text.isascii() and any(x in text for x in _OTHER_DOUBTS):
        return _CUT.split(text)
    return text.split(" ")


def is_plain(text: str) -> bool:
    """May the text be cut at each of its spaces?"""
    if text[:1] == " " or any(x in text for x in _ASCII_DOUBTS):
        return False
    return text.isascii() or not any(x in text for x in _OTHER_DOUBTS)


class ByteIds:
    """Encodes texts to little-endian unsigned 32-bit ids, as the library would.

    The parts of a batch of texts are told apart in Arrow, so only distinct ones are looked up. Known parts have a
    place in one array of ids. When they take more than `remembered` bytes, all are forgotten.
    """

    def __init__(self, name: str = BYTE_BPE, remembered: int = REMEMBERED):
        self.library = tokenizer(name)
        self.remembered = remembered
        self.tokenize = self.library.model.tokenize
        self.letters = byte_letters()
        self.marks = {m: self._plain(m, "") for m in MARKS} | {"": (), None: ()}
        self.line = self._plain("", self.letters[10])
        self._forget()

    def _forget(self) -> None:
        # Places of parts that follow a space, and of those that begin a text. The first place has no ids.
        self.known: dict[str, int] = {}
        self.first: dict[str, int] = {}
        self.starts, self.ids = array("q", [0, 0]), array("I")
        self.held = 0
        self.mark_places: dict[str, int] = {"": 0}

    def _mark(self, mark: str) -> int:
        if mark not in self.mark_places:
            self._keep(mark, self.marks[mark], self.mark_places)
        return self.mark_places[mark]

    def _plain(self, word: str, space: str) -> tuple[int, ...]:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return tuple([t.id for t in self.tokenize(space + word)])

    def _keep(self, part: str, ids: tuple[int, ...] | list[int], known: dict[str, int]) -> None:
        known[part] = len(self.starts) - 1
        self.ids.extend(ids)
        self.starts.append(len(self.ids))
        self.held += OVERHEAD + len(part) + 4 * len(ids)

    def _word(self, word: str, known: dict[str, int], space: str) -> tuple[int, ...] | array:
        at = known.get(word)
        if at is None:
            ids = self._plain(word, space and "Ġ")
            self._keep(word, ids, known)
            return ids
        return self.ids[self.starts[at] : self.starts[at + 1]]

    def _learn_words(self, new: list[str], known: dict[str, int], space: str) -> None:
        """Parts of letters only; each is one pre-token."""
        tokenize, letters, ids, starts = self.tokenize, self.letters, self.ids, self.starts
        before, first = len(ids), len(starts) - 1
        sign = space and "Ġ"
        for word in new:
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(letters)
            ids.extend([t.id for t in tokenize(sign + word)])
            starts.append(len(ids))
        known.update(zip(new, range(first, first + len(new)), strict=True))
        self.held += OVERHEAD * len(new) + sum(map(len, new)) + 4 * (len(ids) - before)

    def _learn(self, new: list[str], known: dict[str, int], space: str) -> None:
        words = [p for p in new if p.isalpha() and (p.isascii() or _PLAIN.fullmatch(p))]
        self._learn_words(words, known, space)
        other = []
        for part in set(new).difference(words):
            plain = _PLAIN.fullmatch(part)
            if plain is None:
                other.append(part)
                continue
            word, mark, second, last = plain.groups()
            ids = [*self._word(word, known, space), *self.marks[mark]]
            if second:
                ids += [*self.line, *self._word(second, self.first, ""), *self.marks[last]]
            self._keep(part, ids, known)
        encoded = self.library.encode_batch_fast(
            [space + part for part in other], add_special_tokens=False
        )
        for part, one in zip(other, encoded, strict=True):
            self._keep(part, one.ids, known)

    def _places(self, distinct: list[str], known: dict[str, int], space: str) -> np.ndarray:
        new = [part for part in distinct if part not in known]
        if new:
            self._learn(new, known, space)
        return np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if self.held > self.remembered:
            self._forget()
        cut = [(i, s) for i, text in enumerate(texts) for s in stretches(text)]
        plain = [is_plain(s) for _, s in cut]
        spaced = pa.array([s for (_, s), p in zip(cut, plain, strict=True) if p], pa.large_string())
        split = pc.split_pattern(spaced, " ")
        odd = [_CUT.split(s) for (_, s), p in zip(cut, plain, strict=True) if not p]
        odd = pa.array(odd, split.type)
        out: list[list[bytes]] = [[] for _ in texts]
        ready = [self._encoded(split), self._encoded(odd)]
        for (i, _), p in zip(cut, plain, strict=True):
            out[i].append(next(ready[not p]))
        # Else Arrow keeps what the batch took, for later ones.
        pa.default_memory_pool().release_unused()
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _encoded(self, lists: pa.ListArray) -> Iterator[bytes]:
        """The ids of texts that are given as lists of their parts, none of them empty."""
        if not len(lists):
            return
        edges = lists.offsets.to_numpy()
        heads, parts = edges[:-1] - edges[0], lists.flatten()
        begin = parts.take(pa.array(heads)).to_pylist()
        begins = list(dict.fromkeys(begin))
        coded = parts.dictionary_encode()
        # A mark after a letter is a pre-token of its own, so only the words before marks are known.
        words, marks = _without_mark(coded.dictionary)
        distinct = words.dictionary_encode()
        places = self._places(distinct.dictionary.to_pylist(), self.known, " ")
        word_places = places[distinct.indices.to_numpy()]
        mark_places = np.array([self._mark(m) for m in ("", *MARKS)])[marks]
        head_places = self._places(begins, self.first, "")
        both = np.stack([word_places, mark_places], axis=1).ravel()
        both = np.concatenate([both, np.stack([head_places, 0 * head_places], axis=1).ravel()])
        # The ids of the batch's distinct parts, then those of all its parts.
        starts, ids = np.array(self.starts, np.int64), np.array(self.ids, np.uint32)
        sizes = np.diff(starts)[both]
        own = _runs(ids, starts[both], sizes)
        sizes = sizes.reshape(-1, 2).sum(axis=1)
        first = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy().astype(np.int64)
        place = {part: i for i, part in enumerate(begins, len(words))}
        at[heads] = [place[part] for part in begin]
        sizes = sizes[at]
        data = memoryview(_runs(own, first[at], sizes).astype("<u4", copy=False).tobytes())
        ends = np.cumsum(sizes)[np.append(heads[1:], len(at)) - 1]
        start = 0
        for end in (4 * ends).tolist():
            yield bytes(data[start:end])
            start = end


def _without_mark(parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts without a last mark that follows a letter, and which mark that was, from 1; 0 for none."""
    mark = pc.index_in(pc.utf8_slice_codeunits(parts, -1), pa.array(list(MARKS), parts.type))
    letter = pc.is_in(pc.utf8_slice_codeunits(parts, -2, -1), pa.array(sorted(LETTERS), parts.type))
    cut = pc.and_(letter, pc.is_valid(mark))
    words = pc.if_else(cut, pc.utf8_slice_codeunits(parts, 0, -1), parts)
    return words, pc.if_else(cut, pc.add(mark, 1), 0).fill_null(0).to_numpy(zero_copy_only=False)


def _runs(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `ids` with these starts and sizes, one after the other."""
    ends = np.cumsum(sizes)
    run = np.repeat(starts - (ends - sizes), sizes)
    run += np.arange(len(run))
    return ids[run]


@lru_cache(maxsize=1)
def byte_ids(name: str = BYTE_BPE, remembered: int = REMEMBERED) -> ByteIds:
    """One encoder per worker, so that words stay known from task to task."""
    return ByteIds(name, remembered)


forget_between(byte_ids.cache_clear, BYTE_IDS)
