"""What several of the operators share: reading, snapshots, salted groups, streams of groups."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import new_folder, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Narrow rows that are no work for more than one task.
ROWS_OF_A_TASK = 200_000


def snapshot(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """A frame written to the shared folder and read back: evaluated once, lineage cut.

    With the number of narrow rows that a shuffle is known to give at most, it is written by as many
    tasks as these rows need, however many partitions the shuffle has.
    """
    if rows is not None:
        df = df.coalesce(-(-max(rows, 1) // ROWS_OF_A_TASK))
    return written(df, new_folder(df.sparkSession, label))


PLAN_CHARS = 1 << 14
#: Bytes of texts that a Python worker holds at a time, unless one text is longer.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send whole texts to Python in batches of at most so many rows and BATCH_BYTES, unless less is set already.

    The plans that need it run later, so it stays set in the session.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}", None)
        if not (now and now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def broadcast(spark: SparkSession, value):
    """A broadcast variable whose value the driver does not go on holding; it is read again where it is needed."""
    shared = spark.sparkContext.broadcast(value)
    vars(shared).pop("_value", None)
    return shared


def short_plans(spark: SparkSession) -> None:
    """Keep texts of plans short, unless they are already: the driver keeps them, and a large literal is written out in full."""
    name = "spark.sql.maxPlanStringLength"
    now = spark.conf.get(name).rstrip("bB")
    if not (now.isdigit() and int(now) <= PLAN_CHARS):
        spark.conf.set(name, str(PLAN_CHARS))


def free_name(df: DataFrame, wanted: str) -> str:
    """A name for a helper column that no column of a frame has."""
    taken = {c.lower() for c in df.columns}
    while wanted in taken:
        wanted += "_"
    return wanted


def let_go() -> None:
    """Give memory that a task has freed back to the machine: Python workers live on for the next stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def freeing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of a task's batches that lets memory go when the task is over."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            let_go()

    return wrapped


def by_bytes(column: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Begin and end of parts of a column of texts with at most so many bytes, unless one text has more."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > begin and held + size > most:
            yield begin, k
            begin, held = k, 0
        held += size
    if len(column) > begin:
        yield begin, len(column)


def strings(column: pa.Array) -> list[str | None]:
    """What ``to_pylist`` gives for texts, without an Arrow scalar for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text under names of our own, so that other columns cannot clash; sets small_batches."""
    small_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def in_block_pairs(rows: DataFrame, key: list[str], member: str, block_rows: int) -> DataFrame:
    """Deal the rows of each key into blocks, and each row to every pair of blocks it is in.

    Rows that share a key meet in exactly one group (key, block_a, block_b) if their own
    blocks differ, and in (key, own, own) if they are the same. A group holds about
    2 * block_rows rows, however many rows a key has; a key of up to block_rows rows is one
    group and costs no copy. Adds own, block_a and block_b.
    """
    sizes = rows.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > block_rows)
    sizes = snapshot(sizes, "sizes")  # a plain table, so that a skewed join can be split
    dealt = rows.join(sizes, key, "left").withColumn(
        "_n", F.ceil(F.coalesce("_n", F.lit(1)) / F.lit(block_rows)).cast("int")
    )
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(member), F.col("_n")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_n") - 1),
        lambda x: F.struct(F.least("own", x).alias("block_a"), F.greatest("own", x).alias("block_b")),
    )
    return dealt.withColumn("_pair", F.explode(pairs)).select("*", "_pair.*").drop("_n", "_pair")


def dealt_and_sorted(rows: DataFrame, *key: str) -> DataFrame:
    """All rows of a key next to each other in one partition."""
    return rows.repartition(*key).sortWithinPartitions(*key)


def groups(batches: Iterator[pa.RecordBatch], key: list[str], least: int = 2) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches sorted by integer key columns.

    Runs shorter than ``least`` are passed over without being built.
    """
    pending: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if pending is not None:
            rows = pa.concat_tables([pending, rows])
        starts = _starts(rows, key)
        yield from _runs(rows, starts[:-1], starts[1:], least)
        pending = rows.slice(starts[-1])
    if pending is not None and pending.num_rows >= least:
        yield pending


def _starts(rows: pa.Table, key: list[str]) -> np.ndarray:
    changed = np.zeros(rows.num_rows, dtype=bool)
    changed[0] = True
    for name in key:
        values = rows.column(name).to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


def _runs(rows: pa.Table, starts, ends, least: int) -> Iterator[pa.Table]:
    for k in np.flatnonzero(np.asarray(ends) - np.asarray(starts) >= least):
        yield rows.slice(int(starts[k]), int(ends[k] - starts[k]))


class Forest:
    """Union-find over positions of a group; the root is the position first given."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def sha256_hex(binary: Column | str) -> Column:
    return F.sha2(F.col(binary) if isinstance(binary, str) else binary, 256)
