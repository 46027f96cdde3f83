"""Documents into training windows of near-equal length, by multiway differencing.

Each task packs the documents it reads, so nothing is shuffled and no key can be hot. A document's
full windows leave at once; what remains of it is cut into short pieces, short neighbours are joined again up
to that length, and all wait until some hundred windows' worth have come together. Karmarkar-Karp differencing spreads them: every piece
starts as a partition of its own into k sums (itself and zeros); the two partitions with the widest
spread are merged, the largest sums of one against the smallest of the other, until one is left. If
its largest sum exceeds the capacity, k rises, so far that the mean falls by the excess, and the differencing
runs again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from airwave.llm.common import CHUNK, Batches, in_tasks, text_chunks, texts
from airwave.llm.tokens import BYTE_BPE, BYTE_IDS, REMEMBERED, byte_ids

CAPACITY = 2048
#: Windows that are packed together; bounds the memory of a task.
WINDOWS = 256
#: A remainder is cut into pieces of at most this many tokens.
PIECE = 512

FIELDS = [
    ("doc_id", T.LongType(), pa.int64()),
    ("start", T.LongType(), pa.int64()),
    ("length", T.LongType(), pa.int64()),
    ("doc_tokens", T.LongType(), pa.int64()),
    ("sequence_id", T.LongType(), pa.int64()),
    ("offset", T.LongType(), pa.int64()),
    ("ids", T.BinaryType(), pa.binary()),
]
SCHEMA = T.StructType([T.StructField(name, kind) for name, kind, _ in FIELDS])


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """The items (their positions in `sizes`) of each of k groups with near-equal sums."""
    if k == 1:
        return [list(range(len(sizes)))]
    # A slot names a node; a node is an item or two joined nodes. -1 is an empty slot.
    joined: list[tuple[int, int]] = []
    heap = []
    for item, size in enumerate(sizes):
        sums, slots = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[-1], slots[-1] = size, item
        heap.append((-size, item, sums, slots))
    heapq.heapify(heap)
    serial = n = len(sizes)
    while len(heap) > 1:
        _, _, sums, slots = heapq.heappop(heap)
        _, _, others, theirs = heap[0]
        sums, theirs = sums + others[::-1], theirs[::-1]
        both = np.flatnonzero((slots >= 0) & (theirs >= 0))
        merged = np.maximum(slots, theirs)
        merged[both] = np.arange(n + len(joined), n + len(joined) + len(both))
        joined += zip(slots[both].tolist(), theirs[both].tolist(), strict=True)
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        # Only differences matter for the order; the full sums stay, as the capacity needs them.
        heapq.heapreplace(heap, (int(sums[0] - sums[-1]), serial, sums, merged[order]))
        serial += 1
    groups = []
    for slot in heap[0][3].tolist():
        group, open_nodes = [], [slot] if slot >= 0 else []
        while open_nodes:
            node = open_nodes.pop()
            if node < n:
                group.append(node)
            else:
                open_nodes += joined[node - n]
        groups.append(sorted(group))
    return groups


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """Groups of at most `capacity`, from the lower bound of their number upwards."""
    total = sum(sizes)
    k = max(1, -(-total // capacity))
    while True:
        groups = differencing(sizes, k)
        excess = max(sum(sizes[i] for i in group) for group in groups) - capacity
        if excess <= 0:
            return [group for group in groups if group]
        # Sums keep about their distance from the mean, so the mean has to fall by the excess.
        k = max(k + 1, int(total / max(1, total / k - excess)))


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str = BYTE_BPE,
    end_id: int = 1,
    windows: int = WINDOWS,
    piece: int = PIECE,
    remembered: int = REMEMBERED,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary).

    `start` counts the document's tokens before the piece, `offset` those of the window before it.
    A null text counts as empty; an empty text has its end id alone. Repeated rows are packed as
    often as they occur, null doc_ids too. Other columns are ignored; an empty table gives no rows.
    `remembered` and `chunk` are bytes that a worker keeps of known words and takes of text at once: they
    change time and memory, not the result. Texts of any length are encoded in stretches; of one text all ids are
    held. Window numbers are unique, ascending within a task, and carry the task's number in the high bits.
    """
    if not 0 < piece <= capacity:
        raise ValueError("a piece must fit a window")

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        encoder = byte_ids(vocabulary, remembered)
        window = TaskContext.get().partitionId() << 40
        tail = int(end_id).to_bytes(4, "little")
        # Pieces that stay together, with their sum: two neighbours always hold more than a piece.
        pending: list[tuple[int, list[tuple]]] = []
        rows: list[tuple] = []
        held = 0

        def spread() -> None:
            nonlocal window, pending, held
            for group in balanced([size for size, _ in pending], capacity):
                offset = 0
                for item in (item for i in group for item in pending[i][1]):
                    rows.append((*item[:4], window, offset, item[4]))
                    offset += item[2]
                window += 1
            pending, held = [], 0

        def out() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, f[2]) for c, f in zip(columns, FIELDS, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, [f[0] for f in FIELDS])

        for doc_ids, values in text_chunks(batches, chunk):
            for doc_id, ids in zip(doc_ids, encoder.batch(values), strict=True):
                ids += tail
                total = len(ids) // 4
                start = 0
                while total - start >= capacity:
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start, capacity, total, window, 0, part))
                    window += 1
                    start += capacity
                while start < total:
                    length = min(piece, total - start)
                    part = ids[4 * start : 4 * (start + length)]
                    size, together = pending[-1] if pending else (piece, [])
                    if size + length <= piece:
                        together.append((doc_id, start, length, total, part))
                        pending[-1] = (size + length, together)
                    else:
                        pending.append((length, [(doc_id, start, length, total, part)]))
                    held += length
                    start += length
                if held >= windows * capacity:
                    spread()
            if rows:
                yield out()
        if pending:
            spread()
        if rows:
            yield out()

    return in_tasks(texts(docs), run, SCHEMA, keeps=BYTE_IDS)
