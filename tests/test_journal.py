"""A run that is killed, at each of its steps, and the run after it."""

import pytest

from quayside.plans import load, publish, run
from quayside.plans.journal import Journal
from quayside.plans.oplog import RunLog


class Killed(BaseException):
    pass


def killed(*_, **__):
    raise Killed


def after(function):
    def wrapped(*args, **kwargs):
        function(*args, **kwargs)
        raise Killed

    return wrapped


def second(function):
    calls = []

    def wrapped(*args, **kwargs):
        calls.append(args)
        if len(calls) == 2:
            raise Killed
        return function(*args, **kwargs)

    return wrapped


# where the run is killed, and whether its files were about to be published by then
PLACES = {
    "write": (load.Loader, "_write", after, False),
    "table": (publish.Publisher, "put_table", second, True),
    "view": (publish.Publisher, "put_view", after, True),
    "after the registry": (publish.Publisher, "remember", after, True),
    "in the archive": (run, "archive_file", second, True),
    "report": (run.Intake, "_report", lambda f: killed, True),
}
FOUR = {s: "SUCCESS" for s in ("VALIDATION", "TABLE_LOAD", "VIEW_REFRESH", "ARCHIVE")}


@pytest.mark.parametrize("place", PLACES)
def test_killed_runs_are_finished(make_landing, monkeypatch, place):
    where, name, how, publishes = PLACES[place]
    landing = make_landing(max_parallel_loads=1)
    landing.put("A_20240101.csv", "A,B\n1,2\n", 2, 1)
    landing.put("B_20240101.csv", "A,B\n1,2\n3,4\n", 2, 2)
    with monkeypatch.context() as patched:
        patched.setattr(where, name, how(getattr(where, name)))
        patched.setattr(RunLog, "abandon", lambda *_: None)
        patched.setattr(Journal, "end", lambda *_: None)
        with pytest.raises(Killed):
            landing.load()
    result = landing.load()
    assert result.files_loaded == (0 if publishes else 2)
    log = landing.store.job_log()
    assert log.where("status = 'RUNNING'").count() == 0
    statuses = [(r.file_nm, r.step_nm, r.status) for r in log.collect()]
    done = [s for s in statuses if s[2] == "SUCCESS"]
    assert sorted(s for s in done if s[1] != "VALIDATION") == sorted(
        (f"{n}_20240101.csv", s, "SUCCESS") for n in "AB" for s in FOUR if s != "VALIDATION"
    )
    assert publishes == (sorted(statuses) == sorted((f"{n}_20240101.csv", s, "SUCCESS") for n in "AB" for s in FOUR))
    audits = [(r.file_nm, r.check_nm) for r in landing.store.audit_log().collect() if r.check_nm == "ROWS_LOADED"]
    assert sorted(audits) == [("A_20240101.csv", "ROWS_LOADED"), ("B_20240101.csv", "ROWS_LOADED")]
    assert (landing.view("A").count(), landing.view("B").count()) == (1, 2)
    assert landing.history() == ["A_20240101.csv", "B_20240101.csv"] and landing.waiting() == []
    assert landing.load().files_found == 0
    folder = landing.root / "store" / "ops" / "open" / landing.category
    assert [p.name for p in folder.iterdir()] == []


def test_a_new_delivery_is_not_archived_for_the_dead_run(make_landing, monkeypatch):
    landing = make_landing(max_parallel_loads=1)
    landing.put("A_20240101.csv", "A,B\n1,2\n", 2, 1)
    with monkeypatch.context() as patched:
        patched.setattr(run.Intake, "_report", killed)
        patched.setattr(RunLog, "abandon", lambda *_: None)
        patched.setattr(Journal, "end", lambda *_: None)
        with pytest.raises(Killed):
            landing.load()
    landing.promised.clear()
    landing.put("A_20240101.csv", "A,B\n5,6\n7,8\n", 2, 2)
    assert landing.load().files_loaded == 1
    assert landing.view("A").count() == 2
