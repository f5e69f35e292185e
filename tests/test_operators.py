import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from quayside.operators import checks, latest, monitor, profile, steplog


def manifest(spark, rows):
    return spark.createDataFrame(rows, "file_nm string, col_cnt int, row_cnt int")


def test_lookup_takes_the_largest_counts_independently(spark):
    lookup = checks.manifest_lookup(manifest(spark, [("A.csv", 1, 9), ("a.CSV", 5, None), ("B.csv", None, None)]))
    rows = {r.file_key: (r.n_listed, r.exp_cols, r.exp_rows) for r in lookup.collect()}
    assert rows == {"A.CSV": (2, 5, 9), "B.CSV": (1, None, None)}


def test_any_case_of_the_manifest_gives_the_same_verdicts(spark):
    rng = random.Random(3)
    rows = [(f"file_{i}.csv", rng.choice([1, 2, None]), rng.randint(0, 2)) for i in range(40)]
    files = spark.createDataFrame(
        [(f"File_{i}.CSV", rng.choice([1, 2]), rng.randint(0, 2)) for i in range(50)],
        "file_nm string, act_cols int, act_rows int",
    )

    def verdicts(spell):
        lookup = checks.manifest_lookup(manifest(spark, [(spell(n), c, r) for n, c, r in rows]))
        judged = checks.verdict(checks.look_up(files, lookup), checks.listed())
        return {r.file_nm: (r.n_listed, r.n_failed) for r in judged.collect()}

    assert verdicts(str.upper) == verdicts(str.lower) == verdicts(str.swapcase)


def test_rows_loaded_needs_a_promise(spark):
    loads = spark.createDataFrame(
        [("a", 5, 5), ("b", 5, 4), ("c", None, 4)], "file_nm string, exp_rows int, rows_loaded long"
    )
    rows = checks.rows_loaded_check(loads, F.col("file_nm")).collect()
    assert {r.file_nm: r.check_status for r in rows} == {"a": "PASS", "b": "FAIL", "c": "FAIL"}


def test_missing_ignores_case_category_and_failed_loads(spark):
    events = spark.createDataFrame(
        [
            ("B.CSV", "X", "TABLE_LOAD", "SUCCESS"),
            ("c.csv", "X", "TABLE_LOAD", "FAILED"),
            ("d.csv", "X", "VALIDATION", "SUCCESS"),
        ],
        "file_nm string, category string, step_nm string, status string",
    )
    listed = manifest(spark, [(n, 1, 1) for n in ("a.csv", "b.csv", "c.csv", "d.csv")])
    there = spark.createDataFrame([("A.CSV",)], "file_nm string")

    def missing(category=None):
        loaded = checks.loaded_before(events, category)
        return sorted(r.file_nm for r in checks.missing_files(listed, there, loaded).collect())

    assert missing() == ["c.csv", "d.csv"]
    assert missing("Y") == ["b.csv", "c.csv", "d.csv"]


def test_counters_add_up(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(200):
        listed = rng.random() < 0.7
        loaded = listed and rng.random() < 0.5
        rows.append((listed, loaded, listed and not loaded))
    outcomes = spark.createDataFrame(rows, "listed boolean, loaded boolean, failed boolean")
    missing = spark.createDataFrame([("x",), ("y",)], "file_nm string")
    row = checks.run_summary(outcomes, missing).first()
    assert row.files_found == row.files_loaded + row.files_failed + row.files_not_in_inventory == 200
    assert row.files_missing == 2


def test_current_state_can_null_an_earlier_message(spark):
    events = spark.createDataFrame(
        [
            (1, "r", "f", "VALIDATION", "RUNNING", "opening", 1),
            (2, "r", "f", "VALIDATION", "SUCCESS", None, None),
            (3, "r", "f", "TABLE_LOAD", "RUNNING", None, None),
        ],
        "seq long, job_run_id string, file_nm string, step_nm string, status string, error_msg string, start_ts int",
    )
    rows = {r.step_nm: r for r in steplog.current_state(events, "seq", ("status", "error_msg")).collect()}
    done = rows["VALIDATION"]
    assert (done.status, done.error_msg, done.start_ts, done.first_seq) == ("SUCCESS", None, 1, 1)
    assert rows["TABLE_LOAD"].status == "RUNNING"


def test_latest_tables(spark):
    tables = spark.createDataFrame(
        [("F_20260914",), ("F_20260915",), ("F_X_20250101",), ("F",), ("F_202609160",), ("F_20260101__STG",)],
        "table_nm string",
    )
    found = {r.base_nm: r.latest_table for r in latest.latest_tables(tables).collect()}
    assert found == {"F": "F_20260915", "F_X": "F_X_20250101", }


def test_column_types(spark):
    cases = {
        "int": ["1", "-22", None],
        "bigint": ["1", "1234567890"],
        "decimal(38,0)": ["1234567890123456789"],
        "decimal(4,2)": ["1.50", "12.25"],
        "decimal(5,2)": ["-123", "0.25"],
        "double": ["1e5", "2", "-0.000123456789012345", "0E999"],
        "date": ["2024-01-01", "9999-12-31"],
        "timestamp_ntz": ["2024-01-01", "2024-01-01 10:00:00"],
        "string": ["1", "x"],
    }
    rows = [(name, i, value) for i, (name, vs) in enumerate(cases.items()) for value in vs]
    kept_as_text = {
        "past a decimal": ["12345678901234567890123456789012345.1234", "1.5"],
        "one power": ["20000000000000000001", "1e2"],
        "overflow": ["12E400", "1"],
        "underflow": ["1e-400"],
        "39 digits": ["1" * 39],
    }
    rows += [(name, 50, value) for name, vs in kept_as_text.items() for value in vs]
    rows += [("nothing", 99, None), ("mixed", 98, "2024-01-01"), ("mixed", 98, "7")]
    frame = spark.createDataFrame(rows, "name string, pos int, value string").withColumn(
        "bad_width", F.lit(False)
    )
    typed = profile.profile_values(frame, "name", "pos").withColumn("column_type", profile.column_type())
    found = {r.name: r.column_type for r in typed.collect()}
    assert {found.pop(name) for name in kept_as_text} == {"string"}
    assert found == {**{name: name for name in cases}, "nothing": "string", "mixed": "string"}


def test_summary_of_informational_messages(spark):
    log = spark.sql(
        """select 'r' job_run_id, 'C' category, 'f' file_nm, s step_nm, 'SUCCESS' status, 't' target_object,
           1L row_cnt, m error_msg, timestamp'2024-01-01 00:00:00.9' start_ts, timestamp'2024-01-01 00:00:01.1' end_ts
           from values ('VALIDATION', null), ('VIEW_REFRESH', 'Points to F_1'), ('ARCHIVE', 'Moved to C/History/') as t(s, m)"""
    )
    row = monitor.load_summary(log).first()
    assert (row.error_msg, row.duration_sec, row.load_status) == ("Points to F_1", 1, None)
    earlier = monitor.earlier_load_summary(log).columns
    assert "archive_status" not in earlier and "missing_status" not in earlier and len(earlier) == 13


def test_a_job_that_fails_for_its_machine_is_no_bad_file(spark):
    from concurrent.futures import ThreadPoolExecutor

    from quayside import IntakeConfig
    from quayside.plans.load import FileLoad, Loader

    def work(group):  # an error without a cause that speaks of an input
        spark.range(1).write.parquet("/proc/none/below")

    files = [FileLoad("F_20240101.csv", "/x/F", 1, 1, False, False, False, 1)]
    with ThreadPoolExecutor(1) as pool, pytest.raises(Py4JJavaError):
        Loader(spark, IntakeConfig("/x", "/y"), "C", "run", None)._each(pool, files, lambda f: 0, work)


def test_a_failing_group_is_halved_down_to_the_bad_files(spark):
    from concurrent.futures import ThreadPoolExecutor

    from quayside import IntakeConfig
    from quayside.plans.load import FileLoad, Loader

    files = [FileLoad(f"F{i}_20240101.csv", f"/x/F{i}", 1, 1, False, False, False, 1) for i in range(16)]
    calls = []

    def work(group):
        calls.append(len(group))
        if any(f.file_nm.startswith(("F3_", "F11_")) for f in group):
            raise RuntimeError("bad")

    loader = Loader(spark, IntakeConfig("/x", "/y"), "C", "run", None)
    with ThreadPoolExecutor(2) as pool:
        loader._each(pool, files, lambda f: 0, work)
    assert [f.file_nm for f in files if f.error] == ["F3_20240101.csv", "F11_20240101.csv"]
    assert len(calls) < 18
