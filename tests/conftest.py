import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside import IntakeConfig, load_category
from quayside.plans.oplog import OpsStore
from quayside.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="quayside-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


class Landing:
    """A landing zone in a temporary folder, with one category."""

    counter = 0

    def __init__(self, spark, tmp_path, **settings):
        Landing.counter += 1
        self.spark, self.root = spark, tmp_path
        self.category = f"T{Landing.counter}"
        self.folder = tmp_path / "landing" / self.category
        self.folder.mkdir(parents=True)
        self.promised = []
        self.cfg = IntakeConfig(
            str(tmp_path / "landing"),
            str(tmp_path / "store"),
            ops_db=f"ops_t{Landing.counter}",
            **settings,
        )
        self.store = OpsStore(spark, self.cfg)

    def put(self, name, content, cols=None, rows=None, listed=True):
        path = self.folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content.encode())
        if listed:
            self.promise(name, cols, rows)
        return path

    def promise(self, name, cols, rows):
        self.promised.append(f"{name},{cols},{rows},2024-01-01,team")

    def announce(self, only=None):
        lines = ["FILE_NM,COL_CNT,ROW_CNT,DATE,OWNER", *(only or self.promised)]
        path = self.folder / f"RDS_Inventory_{self.category}.csv"
        path.write_text("\n".join(lines) + "\n")

    def load(self, announce=True, **options):
        if announce:
            self.announce()
        return load_category(self.spark, self.cfg, self.category.lower(), **options).first()

    def steps(self, run_id=None):
        log = self.store.job_log()
        if run_id:
            log = log.where(log.job_run_id == run_id)
        found = {}
        for row in log.collect():
            found.setdefault(row.file_nm, {})[row.step_nm] = row
        return found

    def statuses(self, run_id=None):
        return {
            name: {step: row.status for step, row in steps.items()}
            for name, steps in self.steps(run_id).items()
        }

    def audits(self, run_id=None):
        log = self.store.audit_log()
        if run_id:
            log = log.where(log.job_run_id == run_id)
        found = {}
        for row in log.orderBy("audit_id").collect():
            found.setdefault(row.file_nm, {})[row.check_nm] = row
        return found

    def table(self, name):
        return self.spark.table(f"{self.category}.{name}")

    def view(self, name):
        return self.spark.table(f"{self.category}_VW.{name}")

    def waiting(self):
        return sorted(p.name for p in self.folder.iterdir() if p.is_file() and p.suffix != ".crc" and not p.name.startswith("RDS_Inventory") and not p.name.endswith(".crc"))

    def history(self):
        path = self.folder / "History"
        return sorted(p.name for p in path.iterdir() if not p.name.endswith(".crc")) if path.exists() else []


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


@pytest.fixture
def make_landing(spark, tmp_path_factory):
    return lambda **settings: Landing(spark, tmp_path_factory.mktemp("zone"), **settings)
