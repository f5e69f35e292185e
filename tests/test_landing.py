"""Whole runs over generated folders: the outcome of every kind of file."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from conftest import Landing

FACILITY = "FACILITY_ID,FACILITY_NAME,ZIP_CD,BED_CNT,COST,EFFECTIVE_DT,ACTIVE_FLG\n"


def facility(n, first=1):
    return FACILITY + "".join(
        f"HDS-F{i:03d},Site {i},{10000 + i},{i * 10},{i}.5,20{i % 30:02d}-01-01,Y\n"
        for i in range(first, first + n)
    )


@pytest.fixture(scope="module")
def mixed(spark, tmp_path_factory):
    """One run over good, bad, odd and absent files."""

    zone = Landing(spark, tmp_path_factory.mktemp("mixed"))
    zone.put("GOOD_20260914.csv", facility(20), 7, 20)
    zone.put("UNLISTED_20260914.csv", "A\n1\n", listed=False)
    zone.put("SHORT_20260914.csv", "A,B\n1,2\n", 3, 1)
    zone.put("LONG_20260914.csv", "A,B\n1,2\n3,4\n", 2, 1)
    zone.put("BOTH_20260914.csv", "A,B\n1,2\n", 3, 7)
    zone.put("NONNUMBER_20260914.csv", "A,B\n1,2\n", 2, "n/a")
    zone.put("ROUNDED_20260914.csv", "A,B\n1,2\n3,4\n", " 2 ", "1.6")
    zone.put("TWICE_20260914.csv", "A,B\n1,2\n3,4\n", 1, 2)
    zone.promise("twice_20260914.CSV", 2, 1)
    zone.put("OTHERCASE_20260914.csv", "A,B\n1,2\n", listed=False)
    zone.promise("othercase_20260914.CSV", 2, 1)
    zone.promise("  ", 2, 1)
    zone.put("EMPTY_20260914.csv", "", 1, 1)
    zone.put("NOTHING_20260914.csv", "", 0, 0)
    zone.put("HEADERONLY_20260914.csv", "A,B\n", 2, 0)
    zone.put("BLANKS_20260914.csv", "A,B\n1,2\n\n   \n3,4\n", 2, 2)
    zone.put("QUOTED_20260914.csv", 'A,B\n1,"x, y"\n2,"say ""hi"""\n', 2, 2)
    zone.put("QUOTEDHEAD_20260914.csv", '"A,1",B\n1,2\n', 2, 1)
    zone.put("BREAKS_20260914.csv", 'A,B\n1,"x\n\ny"\n2,z\n', 2, 2)
    zone.put("RAGGED_20260914.csv", "A,B\n1,2\n3\n", 2, 2)
    zone.put("WIDE_20260914.csv", "A,B\n1,2\n3,4,5\n", 2, 2)
    zone.put("ENDLESS_20260914.csv", 'A,B\n1,"2\n3,4\n', 2, 1)
    zone.put("NULLS_20260914.csv", 'A,B,C\n1,"", x \n2,,\\N\n', 3, 2)
    zone.put("AMOUNTS_20260914.csv", "A,B,C,D\n1.50,1,2024-01-01 10:00:00,12345678901\n12.25,x,2024-01-02 10:00:00,1\n", 4, 2)
    zone.put("NODATE.csv", "A,B\n1,2\n", 2, 1)
    zone.put("sub/NESTED_20260914.csv", "A,B\n1,2\n", listed=False)
    zone.promise("NESTED_20260914.csv", 2, 1)
    zone.put("LINEAGE_20260914.csv", "A,src_file_nm\n1,2\n", 2, 1)
    zone.put("A-B_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.put("DUP_20260914.csv", "A,a\n1,2\n", 2, 1)
    zone.put("_HIDDEN_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.put(".DOTTED_20260914.csv", 'A,B\n1,"x\ny"\n2,3\n', 2, 2)
    zone.put("_BAD %20_20260914.csv", "A,B\n1,2\n", 3, 1)
    zone.put("CANCELLED_20260914.csv", "id,,cancelled_at\n1,2,3\n", 3, 1)
    zone.put("MEMORY_20260914.csv", "A,B\n1,2\nOutOfMemoryError,ExecutorLostFailure,stopped SparkContext\n", 2, 2)
    zone.put("SPACE IN_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.put("PLUS_20260914.x+y%20{z}.csv", "A,B\n1,2\n", 2, 1)
    zone.put("lower_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.promise("GONE_20260914.csv", 2, 1)
    zone.result = zone.load()
    return zone


LOADED = {
    "GOOD_20260914.csv": 20,
    "ROUNDED_20260914.csv": 2,
    "TWICE_20260914.csv": 2,
    "OTHERCASE_20260914.csv": 1,
    "HEADERONLY_20260914.csv": 0,
    "BLANKS_20260914.csv": 2,
    "QUOTED_20260914.csv": 2,
    "BREAKS_20260914.csv": 2,
    "NULLS_20260914.csv": 2,
    "AMOUNTS_20260914.csv": 2,
    "PLUS_20260914.x+y%20{z}.csv": 1,
    "lower_20260914.csv": 1,
    "_HIDDEN_20260914.csv": 1,
    ".DOTTED_20260914.csv": 2,
}
REJECTED = {
    "SHORT_20260914.csv": 1,
    "LONG_20260914.csv": 1,
    "BOTH_20260914.csv": 2,
    "NONNUMBER_20260914.csv": 1,
    "EMPTY_20260914.csv": 2,
    "NESTED_20260914.csv": 2,
    "_BAD %20_20260914.csv": 1,
    "QUOTEDHEAD_20260914.csv": 1,
}
LOAD_ERRORS = (
    "NOTHING_20260914.csv",
    "RAGGED_20260914.csv",
    "WIDE_20260914.csv",
    "ENDLESS_20260914.csv",
    "LINEAGE_20260914.csv",
    "A-B_20260914.csv",
    "DUP_20260914.csv",
    "SPACE IN_20260914.csv",
    "CANCELLED_20260914.csv",
    "MEMORY_20260914.csv",
)


def test_counters(mixed):
    found = len(LOADED) + len(REJECTED) + len(LOAD_ERRORS) + 2
    assert mixed.result.files_found == found
    assert mixed.result.files_loaded == len(LOADED)
    assert mixed.result.files_failed == len(REJECTED) + len(LOAD_ERRORS) + 1
    assert mixed.result.files_not_in_inventory == 1
    assert mixed.result.files_missing == 1
    assert mixed.result.category == mixed.category


def test_good_files_pass_every_step(mixed):
    statuses, steps, audits = mixed.statuses(), mixed.steps(), mixed.audits()
    four = {s: "SUCCESS" for s in ("VALIDATION", "TABLE_LOAD", "VIEW_REFRESH", "ARCHIVE")}
    for name, rows in LOADED.items():
        assert statuses[name] == four, name
        assert steps[name]["TABLE_LOAD"].row_cnt == rows
        assert {c: a.check_status for c, a in audits[name].items()} == {
            c: "PASS" for c in ("FILE_IN_INVENTORY", "COLUMN_COUNT", "ROW_COUNT", "ROWS_LOADED")
        }
        assert audits[name]["ROWS_LOADED"].actual_val == str(rows)


def test_rejected_files_are_skipped(mixed):
    statuses, steps, audits = mixed.statuses(), mixed.steps(), mixed.audits()
    for name, n_failed in REJECTED.items():
        assert statuses[name] == {"VALIDATION": "FAILED", "TABLE_LOAD": "SKIPPED"}, name
        message = steps[name]["VALIDATION"].error_msg
        assert message == f"{n_failed} check(s) failed - see OPS.AUDIT_LOG"
        skipped = steps[name]["TABLE_LOAD"]
        assert skipped.error_msg == f"Validation failed - file left in {mixed.category}/"
        assert skipped.target_object is None and skipped.end_ts is not None
        failed = [a for a in audits[name].values() if a.check_status == "FAIL"]
        assert len(audits[name]) == 3 and len(failed) == n_failed
    assert audits["NONNUMBER_20260914.csv"]["ROW_COUNT"].expected_val is None
    assert audits["EMPTY_20260914.csv"]["ROW_COUNT"].actual_val == "0"
    assert audits["QUOTEDHEAD_20260914.csv"]["COLUMN_COUNT"].actual_val == "3"


def test_unlisted_file(mixed):
    name = "UNLISTED_20260914.csv"
    assert mixed.statuses()[name] == {"VALIDATION": "FAILED", "TABLE_LOAD": "SKIPPED"}
    audits = mixed.audits()[name]
    assert audits["FILE_IN_INVENTORY"].check_status == "FAIL"
    assert "NOT listed" in audits["FILE_IN_INVENTORY"].check_msg
    for check in ("COLUMN_COUNT", "ROW_COUNT"):
        assert audits[check].check_status == "SKIPPED"
        assert audits[check].expected_val is None and audits[check].actual_val is None


def test_load_errors_leave_the_file_and_no_table(mixed, spark):
    statuses, steps = mixed.statuses(), mixed.steps()
    tables = {t.name.upper() for t in spark.catalog.listTables(mixed.category)}
    for name in LOAD_ERRORS:
        assert statuses[name] == {"VALIDATION": "SUCCESS", "TABLE_LOAD": "ERROR"}, name
        assert steps[name]["TABLE_LOAD"].error_msg
        assert name.split(".")[0].upper() not in tables
        assert name in mixed.waiting()


def test_file_without_a_date_has_no_view(mixed):
    assert mixed.statuses()["NODATE.csv"] == {
        "VALIDATION": "SUCCESS",
        "TABLE_LOAD": "SUCCESS",
        "VIEW_REFRESH": "ERROR",
    }
    assert "NODATE.csv" in mixed.waiting()


def test_missing_file(mixed):
    name = "GONE_20260914.csv"
    step = mixed.steps()[name]["FILE_MISSING"]
    assert step.status == "FAILED" and step.target_object is None
    assert step.error_msg == f"In inventory, not in {mixed.category}/, never loaded"
    audit = mixed.audits()[name]["FILE_NAME_EXISTS"]
    assert (audit.expected_val, audit.actual_val, audit.check_status) == ("Y", "N", "FAIL")


def test_files_are_archived(mixed):
    assert mixed.history() == sorted(LOADED)
    assert not set(LOADED) & set(mixed.waiting())


def test_types_follow_the_data(mixed):
    good = dict(mixed.view("GOOD").dtypes)
    assert good == {
        "FACILITY_ID": "string",
        "FACILITY_NAME": "string",
        "ZIP_CD": "int",
        "BED_CNT": "int",
        "COST": "decimal(3,1)",
        "EFFECTIVE_DT": "date",
        "ACTIVE_FLG": "string",
        "SRC_FILE_NM": "string",
        "LOAD_TS": "timestamp",
    }
    amounts = dict(mixed.table("AMOUNTS_20260914").dtypes)
    assert [amounts[c] for c in "ABCD"] == ["decimal(4,2)", "string", "timestamp_ntz", "bigint"]
    header_only = mixed.table("HEADERONLY_20260914")
    assert header_only.dtypes[:2] == [("A", "string"), ("B", "string")] and header_only.count() == 0


def test_values_arrive_whole(mixed):
    rows = {r.A: r for r in mixed.table("NULLS_20260914").collect()}
    assert (rows[1].B, rows[1].C) == ("", "x")
    assert (rows[2].B, rows[2].C) == (None, None)
    assert {r.A: r.B for r in mixed.table("BREAKS_20260914").collect()} == {1: "x\n\ny", 2: "z"}
    assert {r.B for r in mixed.table("QUOTED_20260914").collect()} == {"x, y", 'say "hi"'}


def test_hidden_names_keep_their_own(mixed):
    for name in ("_HIDDEN_20260914.csv", ".DOTTED_20260914.csv"):
        view = mixed.view(name.lstrip(".").removesuffix("_20260914.csv"))
        assert {r.SRC_FILE_NM for r in view.collect()} == {f"{mixed.category}/{name}"}
    assert {r.A: r.B for r in mixed.view("DOTTED").collect()} == {1: "x\ny", 2: "3"}


def test_lineage(mixed):
    rows = mixed.view("GOOD").select("SRC_FILE_NM", "LOAD_TS").distinct().collect()
    assert [r.SRC_FILE_NM for r in rows] == [f"{mixed.category}/GOOD_20260914.csv"]
    odd = mixed.table("PLUS_20260914").first()
    assert odd.SRC_FILE_NM == f"{mixed.category}/PLUS_20260914.x+y%20{{z}}.csv"


def test_monitoring_views(mixed, spark):
    mixed.store.register_monitoring(mixed.category)
    row = spark.sql("select * from vw_load_summary where file_nm = 'GOOD_20260914.csv'").first()
    assert row.error_msg == "Points to GOOD_20260914" and row.rows_loaded == 20
    assert row.target_table == f"RDS_DB.{mixed.category}.GOOD_20260914"
    assert row.target_view == f"RDS_DB.{mixed.category}_VW.GOOD"
    assert row.duration_sec >= 0 and len(row) == 15
    failed = spark.sql("select count(*) n from vw_failed_checks").first().n
    assert failed == sum(REJECTED.values()) + 2
    source = {r.view_name: r for r in spark.sql("select * from vw_current_view_source").collect()}
    assert source["GOOD"].points_to == f"RDS_DB.{mixed.category}.GOOD_20260914"
    assert source["LOWER"].points_to == f"RDS_DB.{mixed.category}.LOWER_20260914"
    comment = {t.name: t.description for t in spark.catalog.listTables(f"{mixed.category}_VW")}
    assert comment["good"] == f"RDS_DB.{mixed.category}.GOOD_20260914"


def test_log_keys(mixed):
    log, audit = mixed.store.job_log(), mixed.store.audit_log()
    assert log.select("job_log_id").distinct().count() == log.count()
    assert audit.select("audit_id").distinct().count() == audit.count()
    assert log.where("job_run_id is null or job_nm is null or created_by is null").count() == 0


def test_second_run_and_later_deliveries(make_landing):
    """Reruns add nothing for loaded files, old reloads keep the newest view, fixes load."""
    zone = make_landing()
    zone.put("F_20260914.csv", facility(5), 7, 5)
    zone.put("BAD_20260914.csv", "A,B\n1,2\n", 2, 9)
    first = zone.load()
    assert (first.files_loaded, first.files_failed) == (1, 1)

    zone.promised = [p for p in zone.promised if not p.startswith("BAD")]
    zone.put("F_20260915.csv", facility(6), 7, 6)
    zone.put("BAD_20260914.csv", "A,B\n1,2\n", 2, 1)
    second = zone.load()
    assert (second.files_found, second.files_loaded, second.files_missing) == (2, 2, 0)
    assert zone.view("F").count() == 6 and zone.table("F_20260914").count() == 5

    zone.put("F_20260914.csv", facility(7), 7, 7)
    zone.promised = [p for p in zone.promised if not p.startswith("F_20260914.csv,7,5")]
    third = zone.load()
    assert third.files_loaded == 1
    assert zone.view("F").count() == 6 and zone.table("F_20260914").count() == 7
    step = zone.steps(third.job_run_id)["F_20260914.csv"]["VIEW_REFRESH"]
    assert step.error_msg == "Points to F_20260915"
    assert zone.history() == ["BAD_20260914.csv", "F_20260914.csv", "F_20260915.csv"]

    before = zone.store.job_events().count(), zone.store.audit_log().count()
    fourth = zone.load()
    assert (fourth.files_found, fourth.files_loaded, fourth.files_missing) == (0, 0, 0)
    assert (zone.store.job_events().count(), zone.store.audit_log().count()) == before


def test_a_failing_file_keeps_the_old_table(make_landing):
    zone = make_landing()
    zone.put("F_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.load()
    zone.promised = []
    zone.put("F_20260914.csv", "A,B\n1,2\n3\n", 2, 2)
    zone.put("F_20260915.csv", "A,B\n1,2\n3\n", 2, 2)
    result = zone.load()
    assert (result.files_loaded, result.files_failed) == (0, 2)
    assert zone.view("F").count() == 1


def test_two_files_of_one_table(make_landing):
    zone = make_landing()
    zone.put("F_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.put("F_20260914.txt", "A,B\n1,2\n3,4\n", 2, 2)
    assert zone.load().files_loaded == 2
    assert zone.view("F").count() == 2


def test_missing_is_reported_every_run_and_history_can_be_split(make_landing):
    zone = make_landing()
    zone.promise("NEVER_20260914.csv", 2, 1)
    assert zone.load().files_missing == 1
    assert zone.load().files_missing == 1
    assert zone.store.failed_checks().count() == 2


def test_no_manifest_lists_nothing(make_landing):
    zone = make_landing()
    zone.put("F_20260914.csv", "A,B\n1,2\n", listed=False)
    result = zone.load(announce=False)
    assert (result.files_found, result.files_not_in_inventory, result.files_missing) == (1, 1, 0)


def test_manifest_driven_run(make_landing):
    zone = make_landing()
    zone.put("F_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.put("BAD_20260914.csv", "A,B\n1,2\n", 2, 5)
    zone.put("UNLISTED_20260914.csv", "A\n1\n", listed=False)
    zone.promise("f_20260914.CSV", 2, 1)
    result = zone.load(driven_by="manifest")
    assert result.asDict().keys() == {"job_run_id", "category", "files_loaded", "files_failed"}
    assert (result.files_loaded, result.files_failed) == (1, 2)
    assert zone.waiting() == ["BAD_20260914.csv", "F_20260914.csv", "UNLISTED_20260914.csv"]
    statuses, audits = zone.statuses(), zone.audits()
    assert "UNLISTED_20260914.csv" not in statuses
    assert statuses["F_20260914.csv"] == {
        "VALIDATION": "SUCCESS",
        "TABLE_LOAD": "SUCCESS",
        "VIEW_REFRESH": "SUCCESS",
    }
    absent = audits["f_20260914.CSV"]
    assert absent["FILE_NAME_EXISTS"].check_status == "FAIL"
    assert absent["FILE_NAME_EXISTS"].check_msg == f"Looked for {zone.category}/f_20260914.CSV on the stage"
    assert absent["COLUMN_COUNT"].check_msg == "File not found in S3"
    assert zone.steps()["BAD_20260914.csv"]["TABLE_LOAD"].error_msg == "Validation failed"


def test_text_columns_keep_codes(make_landing):
    zone = make_landing(text_columns=frozenset({"ZIP"}))
    zone.put("F_20260914.csv", "ID,ZIP\n1,06001\n2,10001\n", 2, 2)
    zone.load()
    assert sorted(r.ZIP for r in zone.view("F").collect()) == ["06001", "10001"]


def test_two_categories_at_the_same_time_on_one_store(spark, tmp_path):
    zones = [Landing(spark, tmp_path) for _ in range(3)]
    shared = zones[0]
    for zone in zones:
        zone.cfg, zone.store = shared.cfg, shared.store
        for day in range(14, 19):
            zone.put(f"F_202609{day}.csv", "A,B\n1,2\n", 2, 1)
        zone.announce()
    with ThreadPoolExecutor(3) as pool:
        results = list(pool.map(lambda zone: zone.load(announce=False), zones))
    assert [r.files_loaded for r in results] == [5, 5, 5]
    audits, events = shared.store.audit_log().collect(), shared.store.job_events().collect()
    assert len(audits) == 3 * 5 * 4 and len({r.audit_id for r in audits}) == len(audits)
    assert len(events) == 3 * 5 * 8 and len({r.event_id for r in events}) == len(events)
    assert spark.table(f"{shared.cfg.ops_db}.audit_log").count() == len(audits)


def test_blank_first_line(landing):
    landing.put("F_20260914.csv", "\n  \nA,B\n1,2\n\n3,4\n", 2, 2)
    assert landing.load().files_loaded == 1
    assert sorted((r.A, r.B) for r in landing.view("F").collect()) == [(1, 2), (3, 4)]


def test_wide_numbers_keep_their_digits(landing):
    values = ["12345678901234567890123456789012345.1234", "1.5"], ["20000000000000000001", "1e2"], ["12E400", "7"]
    landing.put("F_20260914.csv", "A,B,C\n" + "\n".join(map(",".join, zip(*values))) + "\n", 3, 2)
    assert landing.load().files_loaded == 1
    assert sorted(tuple(map(str, r))[:3] for r in landing.view("F").collect()) == sorted(zip(*values))


def test_files_of_a_header_share_a_job(make_landing):
    zone = make_landing()
    zone.put("F_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.put("F_20260915.csv", "A,B\n1,2\n", 2, 1)
    assert zone.load().files_loaded == 2


def test_unreadable_file_does_not_stop_the_others(make_landing):
    zone = make_landing()
    zone.put("F_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.put("BROKEN_20260914.csv.gz", "this is no gzip stream", 2, 1)
    result = zone.load()
    assert (result.files_loaded, result.files_failed) == (1, 1)
    step = zone.steps()["BROKEN_20260914.csv.gz"]
    assert set(step) == {"VALIDATION"} and step["VALIDATION"].status == "ERROR"
    assert 0 < len(step["VALIDATION"].error_msg) <= 1000


def test_catalog_comes_back_in_a_new_session(make_landing, spark):
    zone = make_landing()
    zone.put("F_20260914.csv", "A,B\n1,2\n", 2, 1)
    zone.put("EMPTY_20260914.csv", "A,B\n", 2, 0)
    zone.load()
    for database in (zone.category, f"{zone.category}_VW"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    zone.load()
    assert zone.view("F").count() == 1 and zone.view("EMPTY").count() == 0
