"""Token ids in files that give up single documents.

A file is a run of independent zstandard frames, one per document, each with its content checksum:

    frame of document 0, document 1, ... | index (skippable frame) | seek table (skippable frame)

The seek table follows the public seekable format: per frame its compressed size, its plain size and
32 bits of the plain bytes' XXH64, then a footer. The index holds the document ids. A reader takes
the end of a file, and then only the frames it was asked for. Any zstandard decoder reads the whole.

Spark's own text writer puts the frames on storage, so that its commit protocol covers lost executors
and repeated tasks, and any Hadoop file system will do. That writer ends each row with a separator:
here an empty skippable frame, which belongs to the frame before it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airwave.llm.common import Batches, in_tasks, text_chunks, texts
from airwave.llm.tokens import BYTE_BPE, BYTE_IDS, byte_ids
from airwave.session import stored

# Fixed values of the zstandard seekable format.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80

SEPARATOR = struct.pack("<II", SKIPPABLE, 0)
FOOTER = struct.Struct("<IBI")
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("checksum", "<u4")])
NAMED = np.dtype([("known", "u1"), ("doc_id", "<i8")])

ROWS = "file string, position long, doc_id long, ids binary"


def checksum(plain: bytes) -> int:
    return xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF


def trailer(doc_ids: list[int | None], entries: list[tuple[int, int, int]]) -> bytes:
    """The index and the seek table of one file."""
    named = np.array([(i is not None, i or 0) for i in doc_ids], NAMED).tobytes()
    table = np.array(entries, ENTRY).tobytes() + FOOTER.pack(len(entries), CHECKSUMS, SEEKABLE)
    return b"".join(
        struct.pack("<II", magic, len(part)) + part
        for magic, part in ((SKIPPABLE, named), (SEEK_TABLE, table))
    )


class TokenFile:
    """One file, opened as a seekable stream; reads its end at once and frames when asked."""

    def __init__(self, stream: BinaryIO):
        self.stream = stream
        end = stream.seek(0, 2) - len(SEPARATOR)
        count, flags, magic = FOOTER.unpack(self._at(end - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        size = count * ENTRY.itemsize
        start = end - FOOTER.size - size
        self.entries = np.frombuffer(self._at(start, size), ENTRY)
        # Before the table: its own header, the index, and the index's header in front of that.
        size = count * NAMED.itemsize
        named = np.frombuffer(self._at(start - 8 - size, size), NAMED)
        self.doc_ids = [int(i) if known else None for known, i in named.tolist()]
        self.starts = np.concatenate(([0], np.cumsum(self.entries["packed"], dtype=np.int64)))
        self.lengths = self.entries["plain"].astype(np.int64) // 4

    def _at(self, start: int, size: int) -> bytes:
        if start < 0:
            raise ValueError("the file is shorter than its tables")
        self.stream.seek(start)
        return self.stream.read(size)

    def ids(self, position: int) -> bytes:
        """The ids of one document, little-endian unsigned 32-bit; only its frame is read."""
        entry = self.entries[position]
        packed = self._at(int(self.starts[position]), int(entry["packed"]))
        plain = zstandard.ZstdDecompressor().decompress(packed)
        if len(plain) != entry["plain"] or checksum(plain) != entry["checksum"]:
            raise ValueError(f"frame {position} does not match its checksum")
        return plain

    def find(self, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """The requested documents; ids that the file does not hold are passed over."""
        asked = set(wanted)
        for position, doc_id in enumerate(self.doc_ids):
            if doc_id in asked:
                yield doc_id, np.frombuffer(self.ids(position), "<u4")


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str = BYTE_BPE,
    end_id: int = 2,
    level: int = 3,
) -> None:
    """Encode `docs` (doc_id, text, ...) and write their ids in ascending doc_id order.

    A null text counts as empty; an empty text still has its end id. Null doc_ids come first.
    Repeated rows are written as often as they occur, rows of one doc_id in an unspecified order.
    Other columns are ignored. An empty table gives a folder without frames.
    """
    tail = struct.pack("<I", end_id)

    def frames(batches: Batches) -> Iterator[pa.RecordBatch]:
        encoder = byte_ids(vocabulary)
        packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        doc_ids, entries = [], []
        for ids, values in text_chunks(batches):
            rows = []
            for plain in encoder.batch(values):
                plain += tail
                rows.append(packer.compress(plain))
                entries.append((len(rows[-1]) + len(SEPARATOR), len(plain), checksum(plain)))
            doc_ids += ids
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])
        if entries:
            last = pa.array([trailer(doc_ids, entries)], pa.binary())
            yield pa.RecordBatch.from_arrays([last], ["value"])

    ordered = (
        texts(docs)
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id")
    )
    (
        in_tasks(ordered, frames, "value binary", keeps=BYTE_IDS)
        # The bytes pass through as they are; the writer does not look at them as text.
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR.decode("latin-1"))
        .text(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, doc_id, ids) of every document; `file` is the name, which gives the order."""

    def unpack(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                stream = pa.BufferReader(content.as_buffer())
                if not stream.size():
                    continue
                one = TokenFile(stream)
                for start in range(0, len(one.doc_ids), 256):
                    places = range(start, min(start + 256, len(one.doc_ids)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(places), pa.string()),
                            pa.array(places, pa.int64()),
                            pa.array(one.doc_ids[start : places.stop], pa.int64()),
                            pa.array([one.ids(i) for i in places], pa.binary()),
                        ],
                        ["file", "position", "doc_id", "ids"],
                    )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return in_tasks(files, unpack, ROWS)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, worked out from the files."""
    rows = stored(
        read_token_files(spark, path).select(
            F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("file"),
            "position",
            "doc_id",
            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            F.crc32("ids").alias("ids_crc32"),
        )
    )
    # One row per file, so a single ordered window is small; a file's documents stay in one window.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("in_file"))
    files = files.select("file", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("base"))
    within = (
        Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    )
    return rows.join(files, "file").select(
        "doc_id",
        (F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
