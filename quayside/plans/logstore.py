"""Append-only rows in Parquet folders, compacted behind a snapshot pointer.

Below a log's root::

    live/<name>/                       one append each, moved here when it is whole
    parts/part=<name>/bucket=<b>/      compacted rows, dealt by a bucket that readers can name
    snapshots/<number>.json            which parts count, and which live appends they already hold
    staged/<name>/                     appends and parts that are being written

The log is the parts of the newest whole snapshot and the live appends that it does not name. A compaction writes a
part from the live appends and the parts that are not much larger (so there are few parts, each row being
rewritten a logarithmic number of times), then publishes it by creating the next snapshot, which one writer alone can do. What
a snapshot replaces is deleted by the compaction after the next, so readers of the one before are not disturbed. A crash leaves
the log as it was: what is staged or unnamed does not count, and a torn snapshot is passed over.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import local_frame
from quayside.sources import hadoop

#: Live appends that are left alone.
COMPACT_AFTER = 64
BUCKETS = 16
#: A part is merged with newer rows if it has at most so many times as many.
GROWTH = 4


def bucket_of(key: Column) -> Column:
    """The bucket of a key, as text; ``bucket_of_text`` gives the same without a job."""
    return F.pmod(F.crc32(key.cast("binary")), F.lit(BUCKETS)).cast("string")


def bucket_of_text(key: str) -> str:
    return str(zlib.crc32(key.encode()) % BUCKETS)


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    parts: tuple[dict, ...] = ()  # name, rows, buckets
    absorbed: tuple[str, ...] = ()  # live appends that are in the parts
    dropped: tuple[str, ...] = ()  # parts of the snapshot before that are no more

    def text(self) -> str:
        return json.dumps({"parts": self.parts, "absorbed": self.absorbed, "dropped": self.dropped})


class LogStore:
    """One log. ``bucket`` gives the bucket of a row; with ``newest``, (keys, order), only the newest row of a key matters."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str,
        bucket: Callable[[], Column],
        newest: tuple[tuple[str, ...], str] | None = None,
        sort_by: tuple[str, ...] = (),
    ):
        self.spark, self.root, self.schema = spark, root, schema
        self.bucket, self.newest, self.sort_by = bucket, newest, sort_by

    def ensure(self) -> None:
        for name in ("live", "parts", "snapshots", "staged"):
            hadoop.make_folder(self.spark, f"{self.root}/{name}")

    # -- writing

    def append(self, rows: DataFrame) -> None:
        name = uuid4().hex
        rows.write.parquet(f"{self.root}/staged/{name}")
        hadoop.move(self.spark, f"{self.root}/staged/{name}", f"{self.root}/live/{name}")

    # -- reading

    def _snapshot(self) -> Snapshot:
        numbers = self._numbers()
        for number in sorted(numbers, reverse=True):
            try:
                held = json.loads(hadoop.read_text(self.spark, f"{self.root}/snapshots/{number}.json"))
            except ValueError:  # its writer died; nothing that the one before names is gone
                continue
            return Snapshot(number, tuple(held["parts"]), tuple(held["absorbed"]), tuple(held["dropped"]))
        return Snapshot()

    def _numbers(self) -> list[int]:
        found = hadoop.names_in(self.spark, f"{self.root}/snapshots")
        return [int(n.removesuffix(".json")) for n in found if n.endswith(".json")]

    def _now(self) -> tuple[Snapshot, list[str]]:
        """The snapshot and the live appends beside it, read while no other snapshot came."""
        snapshot = self._snapshot()
        while True:
            live = hadoop.names_in(self.spark, f"{self.root}/live")
            after = self._snapshot()
            if after.number == snapshot.number:
                return snapshot, sorted(set(live) - set(snapshot.absorbed))
            snapshot = after

    def folders(self, buckets: Iterable[str] | None = None) -> list[str]:
        """The folders that make up the log now, of parts only those of some buckets."""
        snapshot, live = self._now()
        wanted = None if buckets is None else set(buckets)
        found = [f"{self.root}/live/{name}" for name in live]
        for part in snapshot.parts:
            own = part["buckets"] if wanted is None else sorted(wanted & set(part["buckets"]))
            found += [f"{self.root}/parts/part={part['name']}/bucket={b}" for b in own]
        return found

    def read(self, buckets: Iterable[str] | None = None) -> DataFrame:
        """All rows, or at least those of some buckets (live rows are not dealt yet)."""
        return self._rows(self.folders(buckets))

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return local_frame(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*folders)

    # -- compacting

    def compact(self, after: int = COMPACT_AFTER) -> bool:
        """Merge the live appends into a part, if there are more than ``after``; False if nothing was published."""
        snapshot, live = self._now()
        if len(live) <= after:
            return False
        merged, left = [], []
        rows = self._rows([f"{self.root}/live/{name}" for name in live]).count()
        for part in sorted(snapshot.parts, key=lambda p: p["rows"]):
            if part["rows"] <= GROWTH * rows:
                merged.append(part)
                rows += part["rows"]
            else:
                left.append(part)
        folders = [f"{self.root}/live/{name}" for name in live]
        folders += [f"{self.root}/parts/part={p['name']}" for p in merged]
        part = self._written(self._rows(folders))
        there = set(hadoop.names_in(self.spark, f"{self.root}/live"))
        new = Snapshot(
            max([snapshot.number, *self._numbers()]) + 1,
            (*left, part),
            tuple(sorted({*live, *(set(snapshot.absorbed) & there)})),
            tuple(p["name"] for p in merged),
        )
        published = hadoop.write_new(self.spark, f"{self.root}/snapshots/{new.number}.json", new.text())
        if not published:  # another run was faster; its part holds these rows
            hadoop.delete(self.spark, f"{self.root}/parts/part={part['name']}")
            return False
        self._forget(snapshot)
        return True

    def _written(self, rows: DataFrame) -> dict:
        """A new part: whole before it stands among the others."""
        name = uuid4().hex
        if self.newest is not None:
            keys, order = self.newest
            others = [c for c in rows.columns if c not in keys]
            kept = F.max_by(F.struct(*others), F.struct(order, *(c for c in others if c != order)))
            rows = rows.groupBy(*keys).agg(kept.alias("kept")).select(*keys, "kept.*").select(*rows.columns)
        dealt = rows.withColumn("bucket", self.bucket()).repartition("bucket")
        dealt = dealt.sortWithinPartitions("bucket", *self.sort_by)
        staged = f"{self.root}/staged/{name}"
        dealt.write.partitionBy("bucket").parquet(staged)
        buckets = sorted(n.removeprefix("bucket=") for n in hadoop.names_in(self.spark, staged) if n.startswith("bucket="))
        count = self._rows([staged]).count()
        hadoop.move(self.spark, staged, f"{self.root}/parts/part={name}")
        return {"name": name, "rows": count, "buckets": buckets}

    def _forget(self, before: Snapshot) -> None:
        """Delete what the snapshot before the new one had replaced, and the snapshots before that."""
        for name in before.absorbed:
            hadoop.delete(self.spark, f"{self.root}/live/{name}")
        for name in before.dropped:
            hadoop.delete(self.spark, f"{self.root}/parts/part={name}")
        for number in self._numbers():
            if number < before.number:
                hadoop.delete(self.spark, f"{self.root}/snapshots/{number}.json")
