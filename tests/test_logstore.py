"""The compacted log: what it holds, what readers list, and what a crash leaves."""

import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from quayside.plans import logstore, oplog
from quayside.plans.logstore import LogStore, bucket_of, bucket_of_text

SCHEMA = "key string, at long, value string"


@pytest.fixture
def log(spark, tmp_path):
    made = LogStore(spark, f"file:{tmp_path}/log", SCHEMA, lambda: bucket_of(F.col("key")), sort_by=("key",))
    made.ensure()
    return made


def add(log, *rows):
    log.append(log.spark.createDataFrame(rows, SCHEMA).coalesce(1))


def held(log, **options):
    return sorted(tuple(r) for r in log.read(**options).collect())


def test_rows_stay_through_compactions(log):
    assert held(log) == []
    rows = []
    for k in range(12):
        rows.append((f"k{k % 5}", k, f"v{k}"))
        add(log, rows[-1])
        log.compact(after=2)
        assert held(log) == sorted(rows)
    parts = os.listdir(f"{log.root[5:]}/parts")
    assert 1 <= len(parts) <= 5
    for key in ("k0", "k4"):
        found = [r for r in held(log, buckets=[bucket_of_text(key)]) if r[0] == key]
        assert found == sorted(r for r in rows if r[0] == key)


def test_buckets_are_the_same_with_and_without_a_job(spark):
    keys = ["", "A", "ORDERS_20240101.CSV", "Zoë", "中文"]
    frame = spark.createDataFrame([(k,) for k in keys], "k string").select("k", bucket_of(F.col("k")).alias("b"))
    assert {r.k: r.b for r in frame.collect()} == {k: bucket_of_text(k) for k in keys}


def test_folders_do_not_grow_with_appends(log):
    add(log, ("a", 1, "x"))
    first, most = f"{log.root[5:]}/one", 0
    shutil.copytree(f"{log.root[5:]}/live/" + os.listdir(f"{log.root[5:]}/live")[0], first)
    for block in range(10):  # 5,000 appends, five hundred before each compaction
        for _ in range(500):
            shutil.copytree(first, f"{log.root[5:]}/live/{uuid.uuid4().hex}")
        assert log.compact(after=64)
        add(log, ("b", block, "y"))
        most = max(most, len(log.folders()))
    assert most <= 12
    assert log.read().count() == 5001 + 10
    assert len(os.listdir(f"{log.root[5:]}/live")) <= 1010
    assert len(os.listdir(f"{log.root[5:]}/snapshots")) <= 6  # with their checksum files


def test_newest_rows_of_a_registry(spark, tmp_path):
    log = LogStore(spark, f"file:{tmp_path}/log", SCHEMA, lambda: bucket_of(F.col("key")), newest=(("key",), "at"))
    log.ensure()
    for k in range(9):
        add(log, ("a", k, f"v{k}"), ("b", -k, f"w{k}"))
        log.compact(after=3)
    newest = {}
    for key, at, value in held(log):
        newest[key] = max(newest.get(key, (at, value)), (at, value))
    assert newest == {"a": (8, "v8"), "b": (0, "w0")}
    assert log.read().count() < 12


class Crash(Exception):
    pass


@pytest.mark.parametrize("place", ["write_new", "move", "delete", "torn"])
def test_a_crash_in_a_compaction_leaves_one_log(log, monkeypatch, place):
    rows = [(f"k{k}", k, "v") for k in range(8)]
    for row in rows[:4]:
        add(log, row)
    assert log.compact(after=2)
    for row in rows[4:]:
        add(log, row)

    def crash(*_):
        raise Crash

    def torn(spark, path, text):
        with open(path.removeprefix("file:"), "w") as file:
            file.write(text[: len(text) // 2])
        raise Crash

    with monkeypatch.context() as patched:
        patched.setattr(logstore.hadoop, "write_new" if place == "torn" else place, torn if place == "torn" else crash)
        with pytest.raises(Crash):
            log.compact(after=2)
    assert held(log) == rows
    add(log, ("z", 9, "v"))
    log.compact(after=0)
    assert held(log) == [*rows, ("z", 9, "v")]
    log.compact(after=0)
    assert held(log) == [*rows, ("z", 9, "v")]


def test_one_of_two_compactions_counts(log, monkeypatch):
    for k in range(4):
        add(log, ("k", k, "v"))
    written = LogStore._written

    def other_first(self, rows):
        monkeypatch.setattr(LogStore, "_written", written)
        assert LogStore(self.spark, self.root, self.schema, self.bucket).compact(after=2)
        return written(self, rows)

    monkeypatch.setattr(LogStore, "_written", other_first)
    log.compact(after=2)
    assert held(log) == [("k", k, "v") for k in range(4)]


def test_runs_read_their_own_buckets(landing, monkeypatch):
    monkeypatch.setattr(logstore, "COMPACT_AFTER", 0)
    monkeypatch.setattr(LogStore.compact, "__defaults__", (0,))
    for day in range(1, 5):
        landing.promised.clear()
        landing.put(f"A_2024010{day}.csv", "A,B\n1,2\n", 2, 1)
        landing.promise("GONE_20240101.csv", 1, 1)
        landing.promise("A_20240101.csv", 2, 1)
        result = landing.load()
        assert (result.files_loaded, result.files_missing) == (1, 1)
    log = landing.store.job_log()
    assert log.where("status = 'RUNNING'").count() == 0
    assert log.where("step_nm = 'TABLE_LOAD' and status = 'SUCCESS'").count() == 4
    events = landing.store.logs["job_events"]
    assert len(events.folders([bucket_of_text("A_20240101.CSV")])) <= len(events.folders()) <= 3 * 2
    assert landing.view("A").first().SRC_FILE_NM.endswith("A_20240104.csv")
    assert landing.spark.table(f"{landing.cfg.ops_db}.job_events").count() == events.read().count()


def test_more_runs_than_a_day_has_numbers(landing, monkeypatch):
    monkeypatch.setattr(oplog, "RUN_BITS", 2)
    landing.store.ensure()
    numbers = [landing.store.claim_run() for _ in range(11)]
    assert len(set(numbers)) == 11


def test_a_dropped_view_is_not_current(landing):
    landing.put("A_20240101.csv", "A,B\n1,2\n", 2, 1)
    landing.put("B_20240101.csv", "A,B\n1,2\n", 2, 1)
    landing.load()
    assert {r.view_name for r in landing.store.current_view_source(landing.category).collect()} == {"A", "B"}
    landing.spark.sql(f"DROP VIEW {landing.category}_VW.B")
    left = landing.store.current_view_source(landing.category).collect()
    assert [(r.view_name, r.points_to) for r in left] == [("A", f"RDS_DB.{landing.category}.A_20240101")]
    assert left[0].last_refreshed is not None
