"""Whose fault a failed job is, and what a run that dies leaves behind."""

import os
import threading
import time

import pytest
from py4j.protocol import Py4JNetworkError
from pyspark.sql import functions as F

from quayside.plans import load
from quayside.plans.faults import BadFile, blames_file

SIGNS = "cancelled OutOfMemoryError ExecutorLostFailure No space left on device stopped SparkContext"


def raised(work):
    with pytest.raises(Exception) as caught:
        work()
    return caught.value


def read(spark, path, schema="a int, b int", **options):
    return spark.read.schema(schema).options(header=True, mode="FAILFAST", enforceSchema=False, **options).csv(str(path))


def test_inputs_are_blamed_whatever_they_say(spark, tmp_path):
    folder = tmp_path / SIGNS
    folder.mkdir()
    for name, content in {"value": f"a,b\n1,{SIGNS}\n", "ragged": f"a,b\n{SIGNS}\n", "header": f"{SIGNS},x\n1,2\n"}.items():
        path = folder / f"{name}.csv"
        path.write_text(content)
        assert blames_file(spark, raised(lambda: read(spark, path).collect())), name
        out = str(tmp_path / name)
        assert blames_file(spark, raised(lambda: read(spark, path).write.parquet(out))), name
    (folder / "x.csv.gz").write_bytes(b"\x1f\x8b\x08no archive")
    assert blames_file(spark, raised(lambda: read(spark, folder / "x.csv.gz").collect()))
    assert blames_file(spark, raised(lambda: read(spark, folder / "none.csv").collect()))
    gone = folder / "gone.csv"
    gone.write_text("a,b\n1,2\n")
    rows = read(spark, gone)
    gone.unlink()
    assert blames_file(spark, raised(rows.collect))
    assert blames_file(spark, BadFile(SIGNS)) and blames_file(spark, KeyError(SIGNS))


def test_machines_are_not_inputs(spark, tmp_path):
    dies = F.udf(lambda x: os._exit(3))
    assert not blames_file(spark, raised(lambda: spark.range(1).select(dies("id")).collect()))
    (tmp_path / "file").write_text("")
    blocked = str(tmp_path / "file" / "below")
    assert not blames_file(spark, raised(lambda: spark.range(1).write.parquet(blocked)))
    assert not blames_file(spark, Py4JNetworkError("gone"))
    grown = F.array_join(F.array_repeat(F.repeat(F.lit("x" * 1000), 1000), 1 << 20), ",")  # more than a text can hold
    error = raised(lambda: spark.range(1).select(F.length(grown)).collect())
    assert not blames_file(spark, error) or "MEMORY" not in str(error)


def test_cancelled_jobs_are_not_inputs(spark):
    found = []

    def work():
        spark.sparkContext.setJobGroup("to cancel", "a job that is cancelled")
        try:
            spark.range(0, 1 << 45, 1, 2).agg(F.max(F.hash("id"))).collect()
        except Exception as error:  # noqa: BLE001
            found.append(error)

    thread = threading.Thread(target=work)
    thread.start()
    for _ in range(100):
        time.sleep(0.1)
        spark.sparkContext.cancelJobGroup("to cancel")
        if not thread.is_alive():
            break
    thread.join(30)
    assert found and not blames_file(spark, found[0])


def test_a_run_that_dies_closes_its_steps(landing, monkeypatch):
    landing.put("A_20240101.csv", "A,B\n1,2\n", 2, 1)
    landing.put("B_20240101.csv", "A,B\n1,2\n", 3, 1)

    def lost(self, group):
        raise Py4JNetworkError("the machines are gone")

    with monkeypatch.context() as patched:
        patched.setattr(load.Loader, "_write", lost)
        with pytest.raises(Py4JNetworkError):
            landing.load()
    assert landing.statuses() == {
        "A_20240101.csv": {"VALIDATION": "SUCCESS", "TABLE_LOAD": "ERROR"},
        "B_20240101.csv": {"VALIDATION": "FAILED", "TABLE_LOAD": "SKIPPED"},
    }
    step = landing.steps()["A_20240101.csv"]["TABLE_LOAD"]
    assert "the machines are gone" in step.error_msg and step.end_ts is not None
    assert landing.load().files_loaded == 1


def test_rows_that_repeat_a_name_in_a_manifest_driven_run(landing):
    landing.put("A_20240101.csv", "A,B\n1,2\n3,4\n", 2, 2)
    landing.promise("A_20240101.csv", 2, 2)
    landing.promise("A_20240101.csv", 2, 7)
    landing.promise("GONE_20240101.csv", 1, 1)
    landing.promise("GONE_20240101.csv", 1, 1)
    result = landing.load(driven_by="manifest")
    assert (result.files_loaded, result.files_failed) == (2, 3)
    audit = landing.store.audit_log().collect()
    loaded = [(r.expected_val, r.actual_val, r.check_status) for r in audit if r.check_nm == "ROWS_LOADED"]
    assert loaded == [("2", "2", "PASS")] * 2
    rows = sorted((r.expected_val, r.check_status) for r in audit if r.check_nm == "ROW_COUNT" and r.file_nm.startswith("A"))
    assert rows == [("2", "PASS"), ("2", "PASS"), ("7", "FAIL")]
    steps = sorted((r.file_nm, r.step_nm, r.status) for r in landing.store.job_log().collect())
    assert steps == sorted(
        [("A_20240101.csv", s, "SUCCESS") for s in ("VALIDATION", "TABLE_LOAD", "VIEW_REFRESH")] * 2
        + [("A_20240101.csv", "VALIDATION", "FAILED"), ("A_20240101.csv", "TABLE_LOAD", "SKIPPED")]
        + [("GONE_20240101.csv", "VALIDATION", "FAILED"), ("GONE_20240101.csv", "TABLE_LOAD", "SKIPPED")] * 2
    )
    assert landing.view("A").count() == 2
