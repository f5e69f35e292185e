"""Best-fit packing of token pieces into sequences with several capacities.

A document's ids and an end id are cut into pieces of at most a sequence's tokens; only longer documents are cut. A
sequence has a capacity for tokens, for documents and for attention cost (the sum of squared piece lengths). Pieces
are placed in falling length; each goes to the open sequence that has room under every capacity and is best
by one of two rules over the vector of residual capacities, each as a share of its capacity and weighted:
``norm`` takes the least norm of what would remain, ``dot`` the greatest product of residual and demand. A piece
that fits nowhere opens a sequence. Both rules score all open sequences at once, as arrays.

Tokens are cut and counted where the texts are read. Only narrow rows (no ids) are shuffled, in turn, so no
key can be hot: tasks get about ``TASK_TOKENS`` tokens each, a mixture of all lengths, which bounds a task's open
sequences and costs at most about one badly filled sequence in ``TASK_TOKENS / tokens``. Sequence numbers hold the
task's number, so they are unique without another pass.

Null and empty texts have the end id only and are packed like others. A very long text gives many pieces, all but the last
of them whole sequences. Rows are packed one for one: repeated and null ids are rows like any other, told apart by ``row``.
Equal scores go to the sequence opened first. Other columns are not read, so their names cannot clash. An empty table gives
no pieces and no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import texts
from quayside.llm.wordbpe import encoder

#: Tokens that one task packs.
TASK_TOKENS = 1 << 25


class Vector(NamedTuple):
    """An amount of each of the three resources."""

    tokens: float
    documents: float
    attention: float


def capacities(tokens: int, documents: int | None = None, attention: int | None = None) -> Vector:
    """A sequence's capacities; those not given never bind."""
    return Vector(tokens, documents or tokens, attention or tokens * tokens)


#: How much the residuals count: a sequence is mostly short of tokens; the others decide between equals.
WEIGHTS = Vector(1.0, 1e-9, 1e-9)


class Sequences:
    """The open sequences of one task."""

    def __init__(self, capacity: Vector, weights: Vector = WEIGHTS, rule: str = "norm"):
        if rule not in ("norm", "dot"):
            raise ValueError(f"no such rule: {rule}")
        self.capacity = np.array(capacity, dtype=np.float64)
        self.weights, self.rule = np.array(weights, dtype=np.float64), rule
        self.residual = np.empty((3, 1024))
        self.number = np.empty(1024, dtype=np.int64)
        self.open = self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """The number of the sequence that takes a piece, and the piece's place in it."""
        demand = np.array([length, 1, length * length], dtype=np.float64)
        room = self.residual[:, : self.open]
        fits = np.flatnonzero(room[0] >= demand[0])
        if len(fits):
            fits = fits[(room[1, fits] >= demand[1]) & (room[2, fits] >= demand[2])]
        at = self._best(room[:, fits], demand, fits) if len(fits) else self._new()
        offset = int(self.capacity[0] - self.residual[0, at])
        self.residual[:, at] -= demand
        number = int(self.number[at])
        if self.residual[:, at].min() < 1:  # no piece fits any more
            self.open -= 1
            self.residual[:, at] = self.residual[:, self.open]
            self.number[at] = self.number[self.open]
        return number, offset

    def _best(self, room: np.ndarray, demand: np.ndarray, fits: np.ndarray) -> int:
        scale = self.capacity[:, None]
        if self.rule == "norm":
            score = -(self.weights @ ((room - demand[:, None]) / scale) ** 2)
        else:
            score = (self.weights * demand / self.capacity) @ (room / scale)
        best = fits[score == score.max()]
        return int(best[np.argmin(self.number[best])])

    def _new(self) -> int:
        if self.open == self.residual.shape[1]:
            self.residual = np.concatenate([self.residual, np.empty_like(self.residual)], axis=1)
            self.number = np.concatenate([self.number, np.empty_like(self.number)])
        self.residual[:, self.open] = self.capacity
        self.number[self.open] = self.opened
        self.open, self.opened = self.open + 1, self.opened + 1
        return self.open - 1


_PIECE = "row long, id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, tokens: int, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """(row, id, piece, start, length, ids_crc32[, ids]) for every piece of every document.

    ``row`` tells documents apart, ``start`` counts the document's ids before the piece, ``ids`` are little-endian
    32-bit integers. Write the result before using it twice: ``row`` goes by the order in which rows are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            texts_ids = encode.column(batch.column("text"))
            for row, doc_id, own_ids in zip(batch.column("row").to_pylist(), batch.column("id").to_pylist(), texts_ids):
                ids = np.append(own_ids, end_id).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), tokens)):
                    part = ids[start : start + tokens].tobytes()
                    own = (row, doc_id, piece, start, len(part) // 4, zlib.crc32(part), part)
                    for column, value in zip(columns, own):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["row", "id", "piece", "start", "length", "ids_crc32", "ids"]
            kept = 7 if with_ids else 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)][:kept], names[:kept])

    rows = texts(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(run, _PIECE + (", ids binary" if with_ids else ""))


def pack(
    found: DataFrame, capacity: Vector, weights: Vector = WEIGHTS, rule: str = "norm", task_tokens: int = TASK_TOKENS
) -> DataFrame:
    """The pieces (written ones, without ids) with sequence and offset, the place of a piece's first id in its sequence."""
    Sequences(capacity, weights, rule)  # refuses what no task could use
    narrow = found.select("row", "id", "piece", "start", "length", "ids_crc32")
    total, longest = narrow.agg(F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.max("length"), F.lit(0))).first()
    if longest > capacity.tokens or longest * longest > capacity.attention or capacity.documents < 1:
        raise ValueError(f"a piece of {longest} tokens does not fit into a sequence of its own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, sequences = TaskContext.get().partitionId() << 40, Sequences(capacity, weights, rule)
        for batch in batches:
            placed = [sequences.place(n) for n in batch.column("length").to_pylist()]
            numbers = pa.array([first + n for n, _ in placed], pa.int64())
            offsets = pa.array([o for _, o in placed], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, numbers, offsets], [*batch.schema.names, "sequence", "offset"]
            )

    dealt = narrow.repartition(max(1, -(-total // task_tokens)))
    dealt = dealt.sortWithinPartitions(F.desc("length"), "row", "piece")
    return dealt.mapInArrow(run, _PIECE + ", sequence long, offset long")


def sequences(found: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence, ids, lengths, row_ids): the ids of each sequence, and its pieces' lengths and documents in order.

    found: written pieces with ids. A sequence is a bounded group: it has at most its capacity of tokens.
    """
    own = placed.select("row", "piece", "id", "length", "sequence", "offset")
    parts = own.join(found.select("row", "piece", "ids"), ["row", "piece"])
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids", "length", "id")))
    return parts.groupBy("sequence").agg(inside.alias("p")).select(
        "sequence",
        F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("p", lambda x: x["length"]).alias("lengths"),
        F.transform("p", lambda x: x["id"]).alias("row_ids"),
    )
