"""Records that run over several lines because a quoted field holds line breaks.

A CSV reader that looks for such records reads a file in one task. Here the lines of
all splits are read in parallel, twice. Whether a split starts inside a quoted field is not
known while it is read, so the first scan counts under both assumptions and gives one row per
split, which tells which assumption holds. The second scan puts records together where their lines are
read; only fragments at the edges of splits are brought together by a shuffle, after their bytes are
summed: a record too long for one value is not gathered, and its file fails.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions import names, text
from quayside.session import session_with, written
from quayside.sources.files import CSV_FORMAT, read_lines

# The functions of this module travel with the job, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a record that is gathered from several splits.
MAX_RECORD_BYTES = 1 << 28

_COUNTED = "file_uri string, block_start long, records_c long, records_o long, end_c int, end_o int"
_ASSEMBLED = "file_uri string, block_start long, record_no long, fragment boolean, record string"


@dataclass(frozen=True)
class QuotedRecords:
    """The records of some files, fragments apart, and the state at the start of each of their splits."""

    records: DataFrame
    splits: DataFrame
    too_long: DataFrame

    def of(self, paths: Sequence[str]) -> QuotedRecords:
        """The same for some of the files; only their part of the records is read."""
        keys = [_file_key(F.lit(path)) for path in paths]
        chosen = self.splits.where(names.decoded("file_uri").isin(list(paths)))
        return QuotedRecords(self.records.where(F.col("file_key").isin(keys)), chosen, self.too_long)


def _file_key(path: Column) -> Column:
    return F.xxhash64(path)


def _states(toggles: np.ndarray, fixed: np.ndarray, before: int) -> np.ndarray:
    """Open-quote state after each line: ``fixed`` is 0/1 where a line decides it, else -1."""
    n = len(toggles)
    flips = np.cumsum(toggles)
    decided = np.where(fixed >= 0, np.arange(n), -1)
    last = np.maximum.accumulate(decided)
    base_state = np.where(last >= 0, fixed[last], before)
    base_flips = np.where(last >= 0, flips[last], 0)
    return base_state ^ ((flips - base_flips) & 1)


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The lines of a task, in order, in parts that each come from one split."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        uri = batch.column("file_uri").to_numpy(zero_copy_only=False)
        start = batch.column("block_start").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((uri[1:] != uri[:-1]) | (start[1:] != start[:-1])) + 1
        bounds = [0, *edges.tolist(), batch.num_rows]
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            yield (uri[lo], int(start[lo])), batch.slice(lo, hi - lo)


def _line_states(lines: pa.RecordBatch, before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each line: is it inside a field that an earlier line opened, does it end inside one, is it blank?"""
    blank, o0, o1 = (
        lines.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
        for c in ("blank", "open_if_closed", "open_if_open")
    )
    fixed = np.where(o0 == o1, o0, -1)
    after = _states(((o0 == 1) & (o1 == 0)).astype(np.int64), fixed, before)
    return np.concatenate(([before], after[:-1])).astype(bool), after.astype(bool), blank.astype(bool)


def _count_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: its records and its state at the end, under both assumptions."""
    found: dict[tuple[str, int], list[int]] = {}  # records and state if closed at the start, then if open
    for key, lines in _by_split(batches):
        own = found.setdefault(key, [0, 0, 0, 1])
        for at in (0, 2):
            inside, open_after, blank = _line_states(lines, own[at + 1])
            own[at] += int((~inside & ~blank).sum())
            own[at + 1] = int(open_after[-1])
    rows = [(uri, start, c, o, end_c, end_o) for (uri, start), (c, end_c, o, end_o) in found.items()]
    yield pa.RecordBatch.from_pylist(
        [dict(zip((f.split()[0] for f in _COUNTED.split(", ")), row)) for row in rows],
        pa.schema(
            [("file_uri", pa.string()), ("block_start", pa.int64()), ("records_c", pa.int64()), ("records_o", pa.int64()), ("end_c", pa.int32()), ("end_o", pa.int32())]
        ),
    )


def _assemble(states: dict[tuple[str, int], tuple[bool, int]]) -> Callable:
    """Puts the records of each split together; states: does a split start inside a field, and after how many records?"""

    def rows(key: tuple[str, int], numbers: list[int], fragments: list[bool], records: pa.Array) -> pa.RecordBatch:
        count = len(numbers)
        columns = [pa.array([key[0]] * count, pa.string()), pa.array([key[1]] * count, pa.int64())]
        columns += [pa.array(numbers, pa.int64()), pa.array(fragments, pa.bool_()), records.cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _ASSEMBLED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, state, held, begun = None, 0, 0, [], False

        def last() -> Iterator[pa.RecordBatch]:
            """What is held when a split ends: a fragment if it goes on in the next one or began before."""
            if held:
                whole = "\n".join(held)
                yield rows(key, [number], [bool(state) or not begun], pa.array([whole], pa.string()))

        for own, lines in _by_split(batches):
            if own != key:
                yield from last()
                key, held, begun = own, [], False
                starts_open, number = states[own]
                state = int(starts_open)
            inside, open_after, blank = _line_states(lines, state)
            state = int(open_after[-1])
            kept = np.flatnonzero(inside | ~blank)
            if not len(kept):
                continue
            texts, starts = lines.column("line").take(pa.array(kept)), np.flatnonzero(~inside[kept])
            if not len(starts):
                held += texts.to_pylist()
                continue
            held += texts.slice(0, starts[0]).to_pylist()
            if held:
                yield rows(key, [number], [not begun], pa.array(["\n".join(held)], pa.string()))
            done = starts[-1] - starts[0]
            offsets = pa.array(starts - starts[0], pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, texts.slice(starts[0], done)), "\n")
            numbers = range(number + 1, number + len(starts))
            if len(starts) > 1:
                yield rows(key, list(numbers), [False] * len(joined), joined)
            number, held, begun = number + len(starts), texts.slice(starts[-1]).to_pylist(), True
        yield from last()

    return run


def _flagged(lines: DataFrame, *kept: str) -> DataFrame:
    return lines.select(
        *kept,
        "file_uri",
        "block_start",
        text.is_blank("line").alias("blank"),
        text.open_after("line").alias("open_if_closed"),
        text.still_open_after("line").alias("open_if_open"),
    )


def split_states(per_split: DataFrame) -> DataFrame:
    """Per split: does it start inside a quoted field, and how many records precede it?"""
    in_file = Window.partitionBy("file_uri").orderBy("block_start")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.when((F.col("end_c") == 1) & (F.col("end_o") == 0), 1).otherwise(0)
    decided = F.when(
        F.col("end_c") == F.col("end_o"),
        F.struct(F.col("end_c").alias("state"), F.col("flips").alias("flips")),
    )
    known = (
        per_split.withColumn(
            "flips", F.sum(flips).over(in_file.rowsBetween(Window.unboundedPreceding, 0))
        )
        .withColumn("decided", F.last(decided, ignorenulls=True).over(earlier))
        .withColumn("flips_before", F.coalesce(F.lag("flips").over(in_file), F.lit(0)))
        .withColumn(
            "starts_open",
            F.coalesce(F.col("decided.state"), F.lit(0)).cast("long").bitwiseXOR(
                (F.col("flips_before") - F.coalesce(F.col("decided.flips"), F.lit(0))) % 2
            )
            == 1,
        )
    )
    records = F.when(F.col("starts_open"), F.col("records_o")).otherwise(F.col("records_c"))
    ends_open = F.when(F.col("starts_open"), F.col("end_o")).otherwise(F.col("end_c")) == 1
    counted = known.withColumn("records", records).withColumn("ends_open", ends_open)
    return counted.select(
        "file_uri",
        "block_start",
        "starts_open",
        "ends_open",
        "records",
        F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("records_before"),
    )


def quoted_records(spark: SparkSession, paths: Sequence[str], scratch: str) -> QuotedRecords:
    """Put the records of files together, once, and keep them.

    Lines end at a line feed alone, so a carriage return inside a field stays in it. Both scans must see the same
    splits, however many executors there are by then, so a session of its own holds what splits depend on. The driver and each task
    hold one row for each split.
    """
    pinned = spark.conf.get("spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism)
    own = session_with(
        spark,
        {
            "spark.sql.files.minPartitionNum": pinned,
            "spark.sql.optimizer.plannedWrite.enabled": "false",
            "spark.sql.maxConcurrentOutputFileWriters": "32",
        },
    )
    lines = read_lines(own, paths, line_sep="\n")
    splits = written(split_states(_flagged(lines).mapInArrow(_count_splits, _COUNTED)), scratch)
    states = {(r.file_uri, r.block_start): (r.starts_open, r.records_before) for r in splits.collect()}
    found = _flagged(lines, "line").mapInArrow(_assemble(states), _ASSEMBLED)
    records = written(found.withColumn("file_key", _file_key(names.decoded("file_uri"))), scratch, "file_key")
    sizes = records.where("fragment").groupBy("file_uri", "record_no").agg(F.sum(F.octet_length("record")).alias("bytes"))
    too_long = sizes.where(F.col("bytes") > MAX_RECORD_BYTES).select("file_uri", "record_no")
    return QuotedRecords(records, splits, written(too_long, scratch))


def record_counts(quoted: QuotedRecords) -> DataFrame:
    """Data records per file, and whether its last quoted field is never closed, or one is too long to be one."""
    counted = quoted.splits.groupBy("file_uri").agg(
        (F.sum("records") - 1).alias("records"),
        F.max_by("ends_open", "block_start").alias("unclosed"),
    )
    long = quoted.too_long.select("file_uri", F.lit(True).alias("long")).distinct()
    return counted.join(long, "file_uri", "left").select(
        "file_uri", "records", (F.col("unclosed") | F.coalesce("long", F.lit(False))).alias("unclosed")
    )


def record_texts(quoted: QuotedRecords) -> DataFrame:
    """``file_uri, record_no, record``: whole records, the header being number 1."""
    whole = quoted.records.where(~F.col("fragment")).select("file_uri", "record_no", "record")
    parts = quoted.records.where("fragment").join(quoted.too_long, ["file_uri", "record_no"], "left_anti")
    pieces = F.sort_array(F.collect_list(F.struct("block_start", "record")))  # of a bounded number of bytes
    joined = parts.groupBy("file_uri", "record_no").agg(
        F.array_join(F.transform(pieces, lambda piece: piece["record"]), "\n").alias("record")
    )
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))


def parse_records(records: DataFrame, types: list[str], mode: str) -> DataFrame:
    """Split record texts into columns c0, c1, ... of the given types; headers are dropped."""
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate(types))
    if mode == "PERMISSIVE":
        schema += ", _corrupt_record string"
    fields = F.from_csv("record", schema, {**CSV_FORMAT, "multiLine": "true", "mode": mode}).alias("fields")
    data = records.where(F.col("record_no") > 1).select("file_uri", fields)
    return data.select("fields.*", "file_uri")
