"""Token ids in succinct files: a wavelet matrix for each shard.

A wavelet matrix keeps a sequence of ids as bit-planes, the highest bit first; each plane is in the order that
sorting stably by the bits before it gives. With the number of ones before each block of a plane,
one walk down the planes answers which id is at a place (access), how often an id occurs before a place
(rank), and where its n-th occurrence is (select), without unpacking the sequence.

A shard is one row of a Parquet file that Spark writes with its commit protocol: its first id's
place in its file, how many documents and ids it has, and one blob in our format (``MAGIC``, sizes,
compressed planes). Documents are dealt to files by ranges of their id, in ascending order (null ids
first, equal ids by the hash of their text), and shards cut that order after whole documents at
about ``SHARD_IDS`` ids; a longer document is a shard of its own. What a task holds is one shard.

Null and empty texts have the end id only. An empty table gives no shards and no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import texts
from quayside.llm.wordbpe import encoder
from quayside.session import new_folder

SHARD_IDS = 1 << 21
BITS = 16
MAGIC = b"WVM1"
#: Bits of a plane between two counts of ones.
BLOCK = 512
_HEADER = struct.Struct("<4sBQQ")
_BLOB = "file int, shard int, first long, n_docs long, n_ids long, blob binary"


class WaveletMatrix:
    """A sequence of ids below 2**bits as bit-planes with counts."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], size: int):
        self.planes, self.zeros, self.size = planes, zeros, size
        self._ones: list[np.ndarray | None] = [None] * len(planes)

    @classmethod
    def of(cls, ids: np.ndarray, bits: int = BITS) -> WaveletMatrix:
        planes, zeros = [], []
        for bit in range(bits - 1, -1, -1):
            ones = (ids & ids.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(ones))
            zero, one = np.flatnonzero(~ones), np.flatnonzero(ones)
            zeros.append(len(zero))
            below = np.empty_like(ids)
            np.take(ids, zero, out=below[: len(zero)], mode="clip")
            np.take(ids, one, out=below[len(zero) :], mode="clip")
            ids = below
        return cls(planes, zeros, len(ids))

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3]) >> (7 - (at & 7)) & 1

    def _ones_before(self, level: int, at: int) -> int:
        counts = self._ones[level]
        if counts is None:
            padded = np.zeros(-(-max(1, len(self.planes[level])) * 8 // BLOCK) * BLOCK // 8, np.uint8)
            padded[: len(self.planes[level])] = self.planes[level]
            per_block = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
            counts = self._ones[level] = np.concatenate([[0], np.cumsum(per_block)])
        block = at // BLOCK
        part = self.planes[level][block * BLOCK // 8 : -(-at // 8)]
        extra = int(np.bitwise_count(part).sum()) if len(part) else 0
        if at & 7 and len(part):
            extra -= (int(part[-1]) & ((1 << (8 - (at & 7))) - 1)).bit_count()
        return int(counts[block]) + extra

    def access(self, at: int) -> int:
        """The id at a place."""
        found = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, at), self._ones_before(level, at)
            found = found << 1 | bit
            at = self.zeros[level] + ones if bit else at - ones
        return found

    def rank(self, value: int, before: int) -> int:
        """How often an id occurs before a place."""
        begin, end = self._range(value, before)
        return end - begin

    def _range(self, value: int, before: int) -> tuple[int, int]:
        begin, end = 0, before
        for level in range(len(self.planes)):
            ones = self._ones_before(level, begin), self._ones_before(level, end)
            if value >> (len(self.planes) - 1 - level) & 1:
                begin, end = self.zeros[level] + ones[0], self.zeros[level] + ones[1]
            else:
                begin, end = begin - ones[0], end - ones[1]
        return begin, end

    def select(self, value: int, nth: int) -> int | None:
        """The place of the nth occurrence (from 0) of an id; None if there are fewer."""
        begin, end = self._range(value, self.size)
        if not 0 <= nth < end - begin:
            return None
        at = begin + nth
        for level in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - level) & 1
            at = self._find(level, at - self.zeros[level], True) if one else self._find(level, at, False)
        return at

    def _find(self, level: int, nth: int, one: bool) -> int:
        """The place of the nth one (or zero) of a plane."""
        low, high = 0, self.size - 1
        while low < high:
            middle = (low + high) // 2
            ones = self._ones_before(level, middle + 1)
            if (ones if one else middle + 1 - ones) > nth:
                high = middle
            else:
                low = middle + 1
        return low

    def all(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        ids = np.zeros(self.size, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.size).view(bool)
            above, zeros = np.empty_like(ids), self.zeros[level]
            ids[zeros:] |= ids.dtype.type(1 << (len(self.planes) - 1 - level))
            above[np.flatnonzero(~ones)], above[np.flatnonzero(ones)] = ids[:zeros], ids[zeros:]
            ids = above
        return ids


def pack(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray, bits: int = BITS) -> bytes:
    """The blob of a shard: its documents' ids and sizes, and the wavelet matrix of its token ids."""
    matrix = WaveletMatrix.of(ids, bits)
    known = np.array([i is not None for i in doc_ids], dtype=np.uint8)
    parts = [
        known.tobytes(),
        np.array([i or 0 for i in doc_ids], dtype="<i8").tobytes(),
        np.array(sizes, dtype="<u8").tobytes(),
        np.array(matrix.zeros, dtype="<u8").tobytes(),
        *(p.tobytes() for p in matrix.planes),
    ]
    packed = [zstandard.ZstdCompressor(level=1).compress(p) for p in parts]
    lengths = np.array([len(p) for p in packed], dtype="<u8").tobytes()
    return _HEADER.pack(MAGIC, bits, len(doc_ids), len(ids)) + lengths + b"".join(packed)


def unpack(blob: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Documents' ids, their sizes and the wavelet matrix of a shard's blob."""
    magic, bits, n_docs, n_ids = _HEADER.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a shard of token ids")
    lengths = np.frombuffer(blob, "<u8", bits + 4, _HEADER.size).tolist()
    begins = accumulate(lengths, initial=_HEADER.size + 8 * len(lengths))
    known, ids, sizes, zeros, *planes = (
        zstandard.ZstdDecompressor().decompress(blob[b : b + n]) for b, n in zip(begins, lengths)
    )
    doc_ids = [int(i) if k else None for i, k in zip(np.frombuffer(ids, "<i8"), known)]
    matrix = WaveletMatrix([np.frombuffer(p, np.uint8) for p in planes], np.frombuffer(zeros, "<u8").tolist(), n_ids)
    return doc_ids, np.frombuffer(sizes, "<u8").astype(np.int64), matrix


def write(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode all texts, an end id after each, and write the shards to a folder."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, encode, end = TaskContext.get().partitionId(), encoder(tokenizer_path), np.array([end_id], "<u2")
        doc_ids, sizes, ids, shard, first, held = [], [], [], 0, 0, 0

        def closed() -> pa.RecordBatch:
            every = np.concatenate(ids)
            row = [file, shard, first, len(doc_ids), len(every), pack(doc_ids, sizes, every)]
            schema = pa.schema([("file", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("blob", pa.binary())])
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema)

        for batch in batches:
            for doc_id, found in zip(batch.column("id").to_pylist(), encode.column(batch.column("text"))):
                own = np.concatenate([found, end])
                if doc_ids and held + len(own) > shard_ids:
                    yield closed()
                    doc_ids, sizes, ids, shard, first, held = [], [], [], shard + 1, first + held, 0
                doc_ids.append(doc_id)
                sizes.append(len(own))
                ids.append(own)
                held += len(own)
        if doc_ids:
            yield closed()

    rows = texts(docs, id_col, text_col).withColumn("_tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts, "id", "_tie").sortWithinPartitions("id", "_tie").drop("_tie")
    dealt.mapInArrow(run, _BLOB).write.mode("errorifexists").parquet(folder)


def read(spark, folder: str) -> DataFrame:
    """(id, start, n_ids, ids) for every document of a folder of shards; ids: little-endian 32-bit integers.

    start counts the ids of all documents before it. The sizes of files are added up on the driver:
    a row for each file, of which there are as many as the writer had partitions.
    """
    shards = spark.read.schema(_BLOB).parquet(folder)
    sizes = sorted((r.file, r.ids) for r in shards.groupBy("file").agg(F.sum("n_ids").alias("ids")).collect())
    bases = dict(zip((f for f, _ in sizes), accumulate((n for _, n in sizes), initial=0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, counts, matrix = unpack(row["blob"])
                ids = matrix.all().astype("<u4")
                ends = np.cumsum(counts)
                begins = ends - counts
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.array(doc_ids, pa.int64()),
                        "start": pa.array(begins + bases[row["file"]] + row["first"]),
                        "n_ids": pa.array(counts),
                        "ids": pa.array([ids[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    }
                )

    return shards.select("file", "first", "blob").mapInArrow(run, "id long, start long, n_ids long, ids binary")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int, **columns: str) -> DataFrame:
    """Write the shards of a table to the shared folder and read them back."""
    folder = new_folder(docs.sparkSession, "tokens")
    write(docs, folder, tokenizer_path, end_id, **columns)
    return read(docs.sparkSession, folder)
