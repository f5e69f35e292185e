"""Logs and registries of an intake, each a compacted log below the store."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import vocabulary as v
from quayside.config import IntakeConfig
from quayside.functions import names
from quayside.operators import monitor, steplog
from quayside.plans.logstore import LogStore, bucket_of, bucket_of_text
from quayside.sources import hadoop
from quayside.sources.catalog import list_catalog, views

AUDIT_SCHEMA = (
    "audit_id long, job_run_id string, category string, file_nm string, check_nm string, "
    "expected_val string, actual_val string, check_status string, check_msg string, "
    "checked_at timestamp"
)
VIEW_SCHEMA = "view_schema string, view_name string, points_to string, refreshed_at timestamp"
TABLE_SCHEMA = (
    "table_schema string, table_nm string, location string, schema_json string, "
    "registered_at timestamp"
)
LOG_KEYS = {"job_events": "event_id", "audit_log": "audit_id"}

ROWS_PER_LOG_PART = 1_000_000
# An id is the number of its run, which no other run has, and its place in that run's logs:
# days since 2020 (14 bits), runs of that day (20 bits), places (29 bits).
FIRST_DAY = date(2020, 1, 1)
RUN_BITS, PLACE_BITS = 20, 29


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


_EXPOSING = Lock()


def _day_of_check():
    return F.coalesce(F.to_date("checked_at").cast("string"), F.lit("none"))


class OpsStore:
    """Reads and appends logs and registries.

    Steps are dealt by file, checks by day, tables by base name and views by schema, so that a run reads what is about its
    own files, tables and views however long the logs have become.
    """

    def __init__(self, spark: SparkSession, cfg: IntakeConfig):
        self.spark = spark
        self.cfg = cfg

        def log(name: str, *settings, **more) -> LogStore:
            return LogStore(spark, self.folder(name), *settings, **more)

        self.logs = {
            "job_events": log("job_events", steplog.EVENT_SCHEMA, file_bucket, sort_by=("file_nm", "event_id")),
            "audit_log": log("audit_log", AUDIT_SCHEMA, _day_of_check, sort_by=("audit_id",)),
            "view_registry": log(
                "view_registry", VIEW_SCHEMA, lambda: bucket_of(F.col("view_schema")),
                newest=(("view_schema", "view_name"), "refreshed_at"),
            ),
            "table_registry": log(
                "table_registry", TABLE_SCHEMA, lambda: bucket_of(names.base_name("table_nm")),
                newest=(("table_schema", "table_nm"), "registered_at"), sort_by=("table_nm",),
            ),
        }

    def folder(self, name: str) -> str:
        return f"{self.cfg.store_root}/ops/{name}"

    def ensure(self) -> None:
        """Create the folders, the ops database and the views of its logs where they are missing."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.cfg.ops_db}`")
        for log in self.logs.values():
            log.ensure()
        if not all(self.spark.catalog.tableExists(f"{self.cfg.ops_db}.{name}") for name in LOG_KEYS):
            self.expose()

    def expose(self) -> None:
        """Point the log views of the ops database at the folders that make up the logs now."""
        with _EXPOSING:
            for name in LOG_KEYS:
                log = self.logs[name]
                within = ",".join(f.removeprefix(f"{log.root}/") for f in log.folders())
                fields = [f.split()[0] for f in log.schema.split(", ")]
                rows = f"SELECT {', '.join(fields)} FROM parquet.`{log.root}/{{{within}}}`"
                if not within:
                    rows = f"SELECT {', '.join('CAST(NULL AS {1}) AS {0}'.format(*f.split()) for f in log.schema.split(', '))} WHERE false"
                self.spark.sql(f"CREATE OR REPLACE VIEW `{self.cfg.ops_db}`.`{name}` AS {rows}")

    def read(self, name: str, buckets: Iterable[str] | None = None) -> DataFrame:
        """A log's rows, at least those of some buckets; of a registry, at least the newest of each key."""
        return self.logs[name].read(buckets)

    def append(self, name: str, rows: DataFrame) -> None:
        self.logs[name].append(rows)

    def compact(self) -> None:
        """Compact the logs that have many appends; one that cannot be compacted now is left for the next run."""
        for log in self.logs.values():
            with suppress(Exception):
                log.compact()

    def claim_run(self) -> int:
        """A number that no other run on this store has, whatever else runs at the same time."""
        day, number = utc_now().date(), 1 << RUN_BITS
        while number >> RUN_BITS:  # a day that is full lends a number of the next one
            folder = f"{self.folder('runs')}/{day.isoformat()}"
            hadoop.make_folder(self.spark, folder)
            number = len(hadoop.names_in(self.spark, folder))
            while not number >> RUN_BITS and not hadoop.create_new(self.spark, f"{folder}/{number}"):
                number += 1
            day += timedelta(days=number >> RUN_BITS)
        return (day - FIRST_DAY).days << RUN_BITS | number

    def job_events(self, buckets: Iterable[str] | None = None) -> DataFrame:
        return self.read("job_events", buckets)

    def job_log(self) -> DataFrame:
        return steplog.job_log(self.job_events())

    def audit_log(self) -> DataFrame:
        return self.read("audit_log")

    def load_summary(self) -> DataFrame:
        """One shuffle, by run and file, serves both the steps' states and the summary."""
        events = self.job_events().repartition("job_run_id", "file_nm")
        return monitor.load_summary(steplog.job_log(events))

    def failed_checks(self) -> DataFrame:
        return monitor.failed_checks(self.audit_log())

    def published_views(self, *categories: str) -> DataFrame:
        """What each view was last pointed at, whether or not the catalog still has it."""
        schemas = [f"{c.upper()}_VW" for c in categories]
        registry = self.read("view_registry", map(bucket_of_text, schemas))
        return monitor.current_view_source(registry, schemas)

    def current_view_source(self, *categories: str) -> DataFrame:
        """The views that the catalog has, what their comments say they serve, and since when they do."""
        there = [views(list_catalog(self.spark, f"{c.upper()}_VW")) for c in categories]
        shown = reduce(DataFrame.unionByName, there).select(
            "table_schema", F.col("table_nm").alias("view_name"), F.col("comment").alias("points_to")
        )
        since = self.published_views(*categories).select(
            F.col("view_schema").alias("table_schema"), "view_name", "last_refreshed"
        )
        return shown.join(since, ["table_schema", "view_name"], "left").withColumnRenamed("table_schema", "view_schema")

    def register_monitoring(self, *categories: str) -> None:
        """Make logs and monitoring views available to SQL in this session."""
        self.job_log().createOrReplaceTempView("job_log")
        self.audit_log().createOrReplaceTempView("audit_log")
        self.load_summary().createOrReplaceTempView("vw_load_summary")
        self.failed_checks().createOrReplaceTempView("vw_failed_checks")
        self.current_view_source(*categories).createOrReplaceTempView("vw_current_view_source")


def file_bucket() -> Column:
    """The bucket of a file's steps."""
    return bucket_of(F.coalesce(names.file_key("file_nm"), F.lit("")))


class RunLog:
    """Collects the steps and checks of one run and appends them, a flush at a time."""

    def __init__(self, store: OpsStore, run_id: str, category: str):
        self.store, self.run_id, self.category = store, run_id, category
        first = store.claim_run() << PLACE_BITS
        self._next = {log: first for log in LOG_KEYS}
        self._pending: dict[str, list[tuple[DataFrame, int]]] = defaultdict(list)
        self._open: dict[str, dict] = {}

    def steps(
        self,
        files: DataFrame,
        n_files: int,
        step: str,
        status: Column | str,
        started: datetime | Column,
        target: Column | None = None,
        row_cnt: Column | None = None,
        error_msg: Column | None = None,
        ended: datetime | Column | None = None,
    ) -> None:
        """One event per file; every event carries the full row."""

        if isinstance(status, str) and status == v.RUNNING:
            self._open[step] = {"files": files, "n_files": n_files, "started": started, "target": target}
        else:
            self._open.pop(step, None)

        def text(value: Column | None) -> Column:
            return (F.lit(None) if value is None else value).cast("string")

        def moment(value: datetime | Column | None) -> Column:
            return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")

        self._add(
            "job_events",
            files,
            n_files,
            job_run_id=F.lit(self.run_id),
            job_nm=F.lit(v.JOB_NAME),
            category=F.lit(self.category),
            file_nm=F.col("file_nm"),
            step_nm=F.lit(step),
            target_object=text(target),
            status=F.lit(status) if isinstance(status, str) else status,
            row_cnt=(F.lit(None) if row_cnt is None else row_cnt).cast("long"),
            error_msg=text(error_msg),
            start_ts=moment(started),
            end_ts=moment(ended),
            created_by=F.current_user(),
            row_no=F.col("row_no") if "row_no" in files.columns else F.lit(0).cast("long"),
        )

    def checks(self, audit: DataFrame, n_rows: int) -> None:
        self._add(
            "audit_log",
            audit,
            n_rows,
            job_run_id=F.lit(self.run_id),
            category=F.lit(self.category),
            file_nm=F.col("file_nm"),
            check_nm=F.col("check_nm"),
            expected_val=F.col("expected_val"),
            actual_val=F.col("actual_val"),
            check_status=F.col("check_status"),
            check_msg=F.col("check_msg"),
            checked_at=F.lit(utc_now()).cast("timestamp"),
        )

    def _add(self, log: str, rows: DataFrame, n_rows: int, **fields: Column) -> None:
        named = [column.alias(name) for name, column in fields.items()]
        self._pending[log].append((rows.select(*named), n_rows))

    def _running(self) -> DataFrame:
        """Steps of this run that the log has begun and not ended."""
        own = self.store.job_events().where(F.col("job_run_id") == self.run_id)
        return steplog.job_log(own, with_row=True).where(F.col("status") == v.RUNNING)

    def is_open(self, step: str) -> bool:
        return not self._running().where(F.col("step_nm") == step).isEmpty()

    def close_open(self, message: str) -> None:
        """End as errors the steps that a run which died has left open."""
        left = self._running().select("file_nm", "row_no", "step_nm", "target_object", "start_ts", "status")
        left = steplog.finish_with_error(left.withColumn("error_msg", F.lit(message)))
        for step, in left.select("step_nm").distinct().collect():
            own = left.where(F.col("step_nm") == step)
            self.steps(
                own, own.count(), step, F.col("status"), F.col("start_ts"), target=F.col("target_object"),
                error_msg=F.col("error_msg"), ended=utc_now(),
            )
        self.flush()

    def abandon(self, error: BaseException) -> None:
        """The run dies of an error: what was decided is logged, steps that are open end as errors."""
        left, self._open = self._open, {}
        with suppress(Exception):  # the error that the run dies of is the one to raise
            self.flush()
        with suppress(Exception):
            now = utc_now()
            for step, opened in left.items():
                running = opened.pop("files").withColumns({"status": F.lit(v.RUNNING), "error_msg": F.lit(str(error))})
                ended = steplog.finish_with_error(running)
                self.steps(ended, step=step, status=F.col("status"), error_msg=F.col("error_msg"), ended=now, **opened)
            self.flush()

    def flush(self) -> None:
        """Append what was collected, each log by one small write, and number the rows."""

        if not self._pending:
            return

        def write(log: str) -> None:
            frames = self._pending.pop(log)
            rows = reduce(DataFrame.unionByName, (frame for frame, _ in frames))
            most = sum(n for _, n in frames)
            parts = max(1, math.ceil(most / ROWS_PER_LOG_PART))
            in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
            number = F.lit(self._next[log]) + F.spark_partition_id() * F.lit(most) + in_part
            # a shuffle of small rows keeps what they are made from in as many tasks as it needs
            numbered = rows.repartition(parts).select(number.alias(LOG_KEYS[log]), "*")
            self._next[log] += parts * most
            self.store.append(log, numbered)

        with ThreadPoolExecutor(2) as pool:
            list(pool.map(write, list(self._pending)))
