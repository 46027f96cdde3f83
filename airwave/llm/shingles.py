"""Hashed word shingles of whole texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

#: Words of a shingle.
WORDS = 5
#: Bytes that are hashed in one go.
STRETCH = 1 << 20

U64 = np.uint64
_FACTOR = U64(0x9E6C63D0876A9A35)
_INVERSE = U64(pow(int(_FACTOR), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result hangs on every bit given."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int, factor: np.uint64 = _FACTOR) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate(([U64(1)], np.full(max(0, n - 1), factor))))


def _ladder(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor for so many bits of places, and their inverses."""
    return powers(1 << bits), powers(1 << bits, _INVERSE)


_kept_ladder = cache(_ladder)


def _stretches(data: bytes) -> Iterator[tuple[int, bytes]]:
    """The bytes in pieces that end at white space."""
    start = 0
    while len(data) - start > STRETCH:
        end = start + STRETCH
        cut = max(data.rfind(b" ", start, end), data.rfind(b"\n", start, end)) + 1
        if cut <= start:
            later = [x for x in (data.find(b" ", end), data.find(b"\n", end)) if x >= 0]
            if not later:
                break
            cut = min(later) + 1
        yield start, data[start:cut]
        start = cut
    yield start, data[start:] if start else data


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of UTF-8 bytes, and where the words begin."""
    hashes, places = [], []
    for base, part in _stretches(data):
        raw = np.frombuffer(part, np.uint8)
        if not len(raw):
            continue
        letter = (raw != 32) & ((raw < 9) | (raw > 13))
        edge = np.flatnonzero(np.diff(letter, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            continue
        bits = (len(raw) - 1).bit_length()
        # Powers by place in the stretch, which each word's first place is divided out of.
        up, down = (_kept_ladder if len(raw) <= STRETCH else _ladder)(bits)
        lower = raw | ((raw - np.uint8(65) < 26).view(np.uint8) << 5)
        sums = np.cumsum((lower.astype(U64) + U64(1)) * up[: len(raw)])
        before = np.where(starts > 0, sums[starts - 1], U64(0))
        hashes.append(mix((sums[ends - 1] - before) * down[starts] + (ends - starts).astype(U64)))
        places.append(starts + base)
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes.

    With fewer words than a shingle has, the whole sequence is one shingle; without words the set is
    empty.
    """
    data = [text.encode("utf-8", "replace") for text in texts]
    sizes = np.array([len(d) + 1 for d in data])
    hashes, places = hash_words(b"\n".join(data))
    bounds = np.searchsorted(places, np.cumsum(sizes))
    weights = mix(np.arange(1, words + 1, dtype=U64)) | U64(1)
    rolled = np.zeros(max(0, len(hashes) - words + 1), U64)
    for i in range(words if len(rolled) else 0):
        rolled += hashes[i : i + len(rolled)] * weights[i]
    rolled = mix(rolled)
    out = []
    start = 0
    for end in bounds.tolist():
        count = end - start
        if count >= words:
            out.append(np.unique(rolled[start : end - words + 1]))
        elif count:
            short = (hashes[start:end] * weights[:count]).sum(dtype=U64, keepdims=True)
            out.append(mix(short + U64(count)))
        else:
            out.append(np.zeros(0, U64))
        start = end
    return out
