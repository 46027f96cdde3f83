"""SentencePiece ids of whole texts, by a forward pass over a trie of distinct marked words.

The model's pieces never hold the word mark behind another character (checked on loading), so a text
falls into marked words, and each distinct word is encoded once. Sorted words are the trie's leaves in
depth-first order: a word's common prefix with the one before keeps its forward states.

The state of a prefix is its last piece. With a unigram model that is the best-scoring one (Viterbi);
but this model is BPE, whose segmentation is not the one of the highest total score. What takes the
place of the score comparison is BPE's own rule: a piece may follow the prefix's last piece exactly if
BPE would leave those two side by side. Merges left and right of a boundary that is never merged run
independently, so the encoding of a prefix is a prefix of the encoding, and exactly one last piece
fits each prefix. Which pieces a prefix may end with is known from the longest end of it that starts a
piece; whether two stay side by side, from the merges inside each, which are worked out once per piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from airwave.llm.common import Batches, in_tasks, slices, texts
from airwave.llm.tokens import vocabulary_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
_MARKED = re.compile(f"{MARK}+[^{MARK}]*")
#: Words whose ids one Python worker keeps, pairs of pieces that it has judged, and steps of the automaton.
REMEMBERED = 500_000


class Pieces:
    """One model: pieces, merge order, byte pieces."""

    def __init__(self, name: str = MODEL):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=vocabulary_path(name))
        count = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(count)]
        usual = [
            i
            for i in range(count)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        self.ids = {self.names[i]: i for i in usual}
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece spans words, so words cannot be encoded on their own")
        self.score = {self.names[i]: model.get_score(i) for i in usual}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # What each id stands for; control ids are silent.
        self.spelled = [
            b"" if model.is_control(i) else name.encode() for i, name in enumerate(self.names)
        ]
        for b, i in enumerate(self.bytes):
            self.spelled[i] = bytes([b])
        # Pieces that BPE makes out of their own characters, and what they start with.
        self.usable = {piece for piece in self.ids if self.merged(piece) == [piece]}
        self.starts = {piece[:end] for piece in self.usable for end in range(len(piece) + 1)}
        self.codes = {piece: pack("<I", self.ids[piece]) for piece in self.usable}
        self.steps: dict[str, tuple[str, list[tuple[str, int]]]] = {}
        self.histories: dict[str, list[tuple[float, str, str]]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}

    def merges(self, text: str) -> Iterator[tuple[float, list[str]]]:
        """BPE by its definition: the best adjacent pair first, of equal ones the leftmost.

        Before each merge its score and the symbols; at last no score and the symbols that stay.
        """
        symbols = list(text)
        while True:
            joined = [a + b for a, b in zip(symbols, symbols[1:])]
            best = max(
                (i for i, piece in enumerate(joined) if piece in self.score),
                key=lambda i: (self.score[joined[i]], -i),
                default=None,
            )
            if best is None:
                yield float("-inf"), symbols
                return
            yield self.score[joined[best]], symbols
            symbols[best : best + 2] = [joined[best]]

    def merged(self, text: str) -> list[str]:
        *_, (_, symbols) = self.merges(text)
        return symbols

    def edges(self, piece: str) -> list[tuple[float, str, str]]:
        """Before each merge inside a piece: its score, the first symbol and the last."""
        found = self.histories.get(piece)
        if found is None:
            found = [(score, symbols[0], symbols[-1]) for score, symbols in self.merges(piece)]
            self.histories[piece] = found
        return found

    def follows(self, last: str, piece: str) -> bool:
        """Whether BPE leaves the two side by side.

        As long as nothing is merged across the boundary, each side's merges go on as they do alone, and of
        the two sides' next merges the better comes first, of equal ones the left.
        """
        score = self.score.get
        left, right = self.edges(last), self.edges(piece)
        i = j = 0
        while True:
            own, _, before = left[i]
            other, after, _ = right[j]
            across = score(before + after)
            if across is not None and across > own and across >= other:
                beside = False
                break
            if own == other == float("-inf"):
                beside = True
                break
            if own >= other:
                i += 1
            else:
                j += 1
        self.pairs[last, piece] = beside
        return beside

    def step(self, text: str) -> tuple[str, list[tuple[str, int]]]:
        """The longest end of `text` that starts a piece, and the pieces that `text` may end with."""
        found = text
        while found not in self.starts:
            found = found[1:]
        ends = [(found[i:], len(found) - i) for i in range(len(found)) if found[i:] in self.usable]
        # A single character is always a symbol, of the vocabulary or not.
        if text[-1] not in self.usable:
            ends.append((text[-1], 1))
        self.steps[text] = found, ends
        return found, ends

    def forward(self, words: list[str]) -> None:
        """Encode distinct words in sorted order, one forward state per trie node on the path."""
        steps, pairs, codes = self.steps.get, self.pairs.get, self.codes.get
        before = ""
        last: list[str] = [""]  # last[i]: the last piece of the path's first i characters
        open_: list[str] = [""]  # open_[i]: their longest end that starts a piece
        for word in sorted(words):
            marked = MARK + word
            shared = 0
            for a, b in zip(before, marked):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], open_[shared + 1 :]
            state = open_[-1]
            for end in range(shared + 1, len(marked) + 1):
                text = state + marked[end - 1]
                state, ends = steps(text) or self.step(text)
                for piece, size in ends:
                    if size < end:
                        pair = last[end - size], piece
                        beside = pairs(pair)
                        if beside is None:
                            beside = self.follows(*pair)
                        if not beside:
                            continue
                    last.append(piece)
                    open_.append(state)
                    break
                else:
                    raise AssertionError(f"no last piece for {marked[:end]!r}")
            before = marked
            path = []
            end = len(marked)
            while end:
                piece = last[end]
                path.append(codes(piece) or self.code(piece))
                end -= len(piece)
            path.reverse()
            self.words[word] = b"".join(path)

    def code(self, character: str) -> bytes:
        """The ids of a character that is no piece: its byte pieces."""
        return pack(f"<{len(character.encode())}I", *(self.bytes[b] for b in character.encode()))

    def cut(self, text: str) -> list[str]:
        """The marked words of a text, each without its first mark."""
        if not text:
            return []
        # A mark stands before the text and for each space.
        words = text.split(" ")
        if MARK in text or "" in words:
            return [word[1:] for word in _MARKED.findall(MARK + text.replace(" ", MARK))]
        return words

    def encode(self, values: list[str]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        cut = [self.cut(v) for v in values]
        if len(self.words) > REMEMBERED:
            self.words = {}
        if len(self.pairs) > REMEMBERED:
            self.pairs = {}
        if len(self.steps) > REMEMBERED:
            self.steps, self.histories = {}, {}
        self.forward(list(set().union(*cut).difference(self.words)))
        known = self.words.__getitem__
        return [b"".join(map(known, words)) for words in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; control ids are silent, byte pieces are read as UTF-8."""
        out = b"".join(map(self.spelled.__getitem__, ids))
        text = out.decode("utf-8", "replace").replace(MARK, " ")
        return text.removeprefix(" ")


@lru_cache(maxsize=2)
def pieces(name: str) -> Pieces:
    return Pieces(name)


def encode_pieces(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids binary) of each row of `docs` (doc_id, text, ...).

    Null and empty texts have no ids. Repeated rows and null doc_ids give a row each, other columns are
    left out, an empty table gives no rows.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        encoder = pieces(model)
        for doc_ids, values in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(encoder.encode(values), pa.binary())],
                ["doc_id", "ids"],
            )

    return in_tasks(texts(docs), run, "doc_id long, ids binary")


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, text) from (doc_id, ids): the text as the model's own decoder gives it."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        decoder = pieces(model)
        for doc_ids, values in slices(batches):
            decoded = [decoder.decode(np.frombuffer(v or b"", "<u4").tolist()) for v in values]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(values, pa.binary()),
                    pa.array(decoded, pa.string()),
                ],
                ["doc_id", "ids", "text"],
            )

    columns = encoded.select("doc_id", "ids")
    return in_tasks(columns, run, "doc_id long, ids binary, text string")
