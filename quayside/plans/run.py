"""One intake run over a category: check, load, publish, archive, report."""

from __future__ import annotations

import copy
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quayside import vocabulary as v
from quayside.config import IntakeConfig
from quayside.functions import names
from quayside.operators import checks, measure
from quayside.plans.faults import blames_file
from quayside.plans.journal import Journal
from quayside.plans.load import FileLoad, Loader, waves
from quayside.plans.oplog import OpsStore, RunLog, file_bucket, utc_now
from quayside.plans.publish import Publisher, archive_file
from quayside.session import local_frame, new_folder, written
from quayside.sources import hadoop, quoted
from quayside.sources.folder import list_folder, waiting_files
from quayside.sources.manifest import read_manifest

FOLDER_RESULT = (
    "job_run_id string, category string, files_found long, files_loaded long, "
    "files_failed long, files_not_in_inventory long, files_missing long"
)
MANIFEST_RESULT = "job_run_id string, category string, files_loaded long, files_failed long"
LOADS = (
    "file_nm string, row_no long, exp_rows long, rows_loaded long, label string, error string, "
    "started timestamp, ended timestamp"
)
STEPS = (
    "file_nm string, row_no long, target string, status string, error_msg string, "
    "started timestamp, ended timestamp"
)


@dataclass
class Outcome:
    """What became of one file, for the counters of the run."""

    listed: bool = True
    loaded: bool = False
    failed: bool = False


def load_category(
    spark: SparkSession, cfg: IntakeConfig, category: str, driven_by: str | None = None
) -> DataFrame:
    """Run an intake for one category and return its one-row summary.

    One run per category at a time.
    """
    if driven_by is not None:
        cfg = replace(cfg, driven_by=driven_by)
    category = category.upper()
    if not category or len(category) > v.CATEGORY_LENGTH:
        raise ValueError(f"a category has 1 to {v.CATEGORY_LENGTH} characters: {category!r}")
    return Intake(spark, cfg, category).run()


class Intake:
    def __init__(self, spark: SparkSession, cfg: IntakeConfig, category: str):
        root = hadoop.qualified(spark, cfg.landing_root)
        store = hadoop.qualified(spark, cfg.store_root)
        cfg = replace(cfg, landing_root=root, store_root=store)
        self.spark, self.cfg, self.category = spark, cfg, category
        self.folder = cfg.folder(category)
        self.run_id = str(uuid.uuid4())
        self.store = OpsStore(spark, cfg)
        self.store.ensure()
        with ThreadPoolExecutor(2) as pool:
            opened = pool.submit(RunLog, self.store, self.run_id, category)
            self.publisher = Publisher(spark, cfg, self.store, category)
            self.publisher.rehydrate()
            self.log = opened.result()
        self.scratch = new_folder(spark, "intake")
        self.journal = Journal(spark, f"{self.store.folder('open')}/{category}", self.run_id)

    def run(self) -> DataFrame:
        try:
            for journal in self.journal.unfinished():
                self._recover(journal)
            self.journal.begin()
            result = self._run()
        except BaseException as error:
            self.log.abandon(error)
            raise
        finally:
            hadoop.delete(self.spark, self.scratch)
            self.journal.end()
        self.store.compact()
        self.store.expose()
        return result

    def _recover(self, journal: Journal) -> None:
        """Finish what a run that died was about to publish; what else it had open ends as an error."""
        dead = copy.copy(self)
        dead.run_id, dead.journal = journal.run_id, journal
        dead.log = RunLog(self.store, journal.run_id, self.category)
        intent = journal.intent()
        if intent is None:
            hadoop.delete(self.spark, f"{self.cfg.store_root}/tables/{self.category}/{journal.run_id}")
        else:
            driven_by, loads = intent
            dead._look_up(loads)
            published = dead._publish(dead._close_loads(loads, again=True))
            if driven_by == "folder":
                dead._archive(published, again=True)
        dead.log.flush()
        dead.log.close_open(v.MSG_RUN_DIED)
        journal.end()

    def _run(self) -> DataFrame:
        listing = list_folder(
            self.spark, self.cfg.landing_root, self.folder, skip=(self.cfg.history(self.category),)
        )
        manifest_path = (
            f"{self.cfg.landing_root}/{self.folder}{self.cfg.manifest_name(self.category)}"
        )
        manifest = self._kept(read_manifest(self.spark, manifest_path))
        if self.cfg.driven_by == "manifest":
            return self._by_manifest(manifest, listing)
        return self._by_folder(manifest, listing)

    def _kept(self, df: DataFrame) -> DataFrame:
        return written(df, self.scratch)

    # -- driven by the folder

    def _by_folder(self, manifest: DataFrame, listing: DataFrame) -> DataFrame:
        waiting = waiting_files(
            listing, self.folder, self.cfg.history(self.category), self.cfg.manifest_prefix
        )
        files = self._kept(checks.look_up(waiting, checks.manifest_lookup(manifest)))
        found = files.select("file_nm", "relative_path", "file_path", "n_listed").collect()
        n_files = len(found)
        outcomes = {row.file_path: Outcome(listed=row.n_listed > 0) for row in found}
        if n_files:
            paths = [r.file_path for r in found if r.n_listed > 0 and self._in_place(r)]
            verdicts, records = self._validate(files, n_files, paths, checks.listed())
            manifest_name = self.cfg.manifest_name(self.category)
            audit = (
                checks.in_manifest_check(verdicts, manifest_name)
                .unionByName(checks.count_checks(_measured(verdicts, checks.listed())))
                .unionByName(
                    checks.skipped_checks(verdicts.where(~checks.listed()), v.MSG_SKIPPED_UNLISTED)
                )
            )
            self.log.checks(audit, 3 * n_files)
            left = v.MSG_LEFT_IN_FOLDER.format(folder=self.folder)
            self._close_validation(verdicts, n_files, left)
            loads = self._load(verdicts, records)
            published = self._publish(loads)
            archived = self._archive(published)
            for path, outcome in outcomes.items():
                outcome.loaded = path in archived
                outcome.failed = outcome.listed and not outcome.loaded
        return self._report(manifest, files, list(outcomes.values()))

    def _report(
        self, manifest: DataFrame, files: DataFrame, outcomes: list[Outcome]
    ) -> DataFrame:
        """Log the missing files and return the counters of the run."""
        only = self.category if self.cfg.history_by_category else None
        absent = checks.not_in_folder(manifest, files)
        buckets = [row.bucket for row in absent.select(file_bucket().alias("bucket")).distinct().collect()]
        history = checks.loaded_before(self.store.job_events(buckets), only, absent)
        missing = self._kept(checks.missing_files(manifest, files, history))
        frame = local_frame(
            self.spark,
            [(o.listed, o.loaded, o.failed) for o in outcomes],
            "listed boolean, loaded boolean, failed boolean",
        )
        counters = checks.run_summary(frame, missing).first()
        if counters.files_missing:
            self.log.checks(checks.missing_audit(missing, self.folder), counters.files_missing)
            now = utc_now()
            self.log.steps(
                missing,
                counters.files_missing,
                v.FILE_MISSING,
                v.FAILED,
                now,
                error_msg=F.lit(v.MSG_STEP_MISSING.format(folder=self.folder)),
                ended=now,
            )
        self.log.flush()
        return local_frame(self.spark, [(self.run_id, self.category, *counters)], FOLDER_RESULT)

    # -- driven by the manifest

    def _by_manifest(self, manifest: DataFrame, listing: DataFrame) -> DataFrame:
        """Walk the manifest rows; unlisted files are not looked at, nothing is archived."""
        numbered = manifest.withColumn("row_no", F.monotonically_increasing_id())  # kept below, so it stays
        promised = numbered.withColumn(
            "relative_path", F.concat(F.lit(self.folder), F.col("file_nm"))
        ).withColumnsRenamed({"col_cnt": "exp_cols", "row_cnt": "exp_rows"})
        files = self._kept(
            checks.manifest_presence(
                promised, listing, F.col("relative_path"), "file_path", "size"
            )
        )
        found = files.select("file_nm", "relative_path", "file_path").collect()
        n_files, n_loaded = len(found), 0
        present = F.col("n_found") > 0
        if n_files:
            paths = sorted({r.file_path for r in found if r.file_path is not None})
            verdicts, records = self._validate(files, n_files, paths, present)
            looked = F.replace(
                F.lit(v.MSG_LOOKED_FOR.format(folder=self.folder, file="{file}")),
                F.lit("{file}"),
                F.col("file_nm"),
            )
            audit = (
                checks.presence_check(verdicts, v.FILE_NAME_EXISTS, present, looked, looked)
                .unionByName(checks.count_checks(_measured(verdicts, present)))
                .unionByName(checks.skipped_checks(verdicts.where(~present), v.MSG_SKIPPED_ABSENT))
            )
            self.log.checks(audit, 3 * n_files)
            self._close_validation(verdicts, n_files, v.MSG_VALIDATION_FAILED)
            published = self._publish(self._load(verdicts, records))
            self.log.flush()
            n_loaded = sum(len(f.row_nos) for f in published)
        result = (self.run_id, self.category, n_loaded, n_files - n_loaded)
        return local_frame(self.spark, [result], MANIFEST_RESULT)

    # -- steps both share

    def _in_place(self, row: Row) -> bool:
        """Files in folders below the category folder are found but never read."""
        return row.relative_path == self.folder + row.file_nm

    def _table_label(self) -> Column:
        return F.concat(
            F.lit(self.cfg.table_label(self.category, "")), names.table_name("file_nm")
        )

    def _validate(
        self, files: DataFrame, n_files: int, paths: list[str], present: Column
    ) -> tuple[DataFrame, quoted.QuotedRecords | None]:
        """Open the validation steps, measure the files at ``paths``, judge all files."""
        self.opened = utc_now()
        self.log.steps(
            files, n_files, v.VALIDATION, v.RUNNING, self.opened, target=self._table_label()
        )
        self.log.flush()
        measures, records, errors = self._measure(paths)
        unread = local_frame(self.spark, list(errors.items()), "file_path string, error string")
        judged = checks.verdict(measure.with_measures(files, measures), present)
        return self._kept(judged.join(unread, "file_path", "left")), records

    def _measure(self, paths: list[str]):
        """Measure all files in one job; if that fails, find the files that cannot be read."""
        if not paths:
            return local_frame(self.spark, [], measure.MEASURES), None, {}
        try:
            return *measure.measure_files(self.spark, paths, self.scratch), {}
        except Exception as error:
            if not blames_file(self.spark, error):
                raise
            if len(paths) <= 1:
                nothing = local_frame(self.spark, [], measure.MEASURES)
                return nothing, None, {path: _cut(error) for path in paths}
        errors = self._unreadable(paths)
        readable = [path for path in paths if path not in errors]
        return *measure.measure_files(self.spark, readable, self.scratch), errors

    def _unreadable(self, paths: list[str]) -> dict[str, str]:
        """Halve the list until the files that make a scan fail stand alone."""
        try:
            measure.measure_lines(measure.read_lines(self.spark, paths)).count()
            return {}
        except Exception as error:
            if not blames_file(self.spark, error):
                raise
            if len(paths) == 1:
                return {paths[0]: _cut(error)}
        half = len(paths) // 2
        return {**self._unreadable(paths[:half]), **self._unreadable(paths[half:])}

    def _close_validation(self, verdicts: DataFrame, n_files: int, skipped: str) -> None:
        now = utc_now()
        closed = checks.validation_outcome(verdicts)
        unread = F.col("error").isNotNull()
        self.log.steps(
            closed,
            n_files,
            v.VALIDATION,
            F.when(unread, v.ERROR).otherwise(F.col("status")),
            self.opened,
            target=self._table_label(),
            error_msg=F.coalesce("error", "error_msg"),
            ended=now,
        )
        held = checks.load_gate(verdicts).where((F.col("decision") == v.SKIPPED) & ~unread)
        self.log.steps(
            held, n_files, v.TABLE_LOAD, v.SKIPPED, now, error_msg=F.lit(skipped), ended=now
        )

    def _load(
        self, verdicts: DataFrame, records: quoted.QuotedRecords | None
    ) -> list[FileLoad]:
        """Load the files that passed, each once, and log the load steps for every manifest row."""
        by_path: dict[str, FileLoad] = {}
        for row in _passed(verdicts).collect():
            known = by_path.get(row.file_path)
            if known is not None:  # rows that passed promise the same, as both agree with the file
                known.row_nos.append(row.row_no)
                continue
            by_path[row.file_path] = FileLoad(
                row.file_nm,
                row.file_path,
                row.size,
                row.header_key,
                bool(row.header_open),
                bool(row.broken_lines),
                bool(row.unclosed),
                None if row.exp_rows is None else int(row.exp_rows),
                [row.row_no if "row_no" in verdicts.columns else 0],
            )
        loads = sorted(by_path.values(), key=lambda f: f.file_nm)
        if not loads:
            self.log.flush()
            return loads
        opened = utc_now()
        self._look_up(loads)
        frame = local_frame(self.spark, [(f.file_nm, n) for f in loads for n in f.row_nos], "file_nm string, row_no long")
        n_rows = sum(len(f.row_nos) for f in loads)
        self.log.steps(
            frame, n_rows, v.TABLE_LOAD, v.RUNNING, opened, target=self._table_label()
        )
        self.log.flush()
        Loader(self.spark, self.cfg, self.category, self.run_id, records).load(loads)
        self.journal.will_publish(loads, self.cfg.driven_by)
        return self._close_loads(loads)

    def _look_up(self, loads: list[FileLoad]) -> None:
        """Earlier loads of the tables of this run, and the newest tables of their base names."""
        self.publisher.prepare(f.table_nm for f in loads)
        self.newest = self.publisher.latest(_base(f) for f in loads)

    def _close_loads(self, loads: list[FileLoad], again: bool = False) -> list[FileLoad]:
        """Register what was loaded and log how each load ended; ``again``: unless the log has it already."""
        self._register(loads)
        if again and not self.log.is_open(v.TABLE_LOAD):
            return loads
        n_rows = sum(len(f.row_nos) for f in loads)
        done = local_frame(
            self.spark,
            [
                (
                    f.file_nm,
                    row_no,
                    f.exp_rows,
                    f.rows_loaded,
                    self.cfg.table_label(self.category, f.table_nm),
                    None if f.error is None else _cut(f.error),
                    f.started,
                    f.ended,
                )
                for f in loads
                for row_no in f.row_nos
            ],
            LOADS,
        )
        ended_well = F.col("error").isNull()
        checked = checks.rows_loaded_check(done.where(ended_well), F.col("label"))
        self.log.checks(checked, n_rows)
        same = F.col("rows_loaded") == F.col("exp_rows")
        self.log.steps(
            done,
            n_rows,
            v.TABLE_LOAD,
            F.when(~ended_well, v.ERROR).when(same, v.SUCCESS).otherwise(v.FAILED),
            F.col("started"),
            target=F.col("label"),
            row_cnt=F.when(ended_well, F.col("rows_loaded")),
            error_msg=F.coalesce("error", F.when(~same, v.MSG_ROWS_DIFFER)),
            ended=F.col("ended"),
        )
        return loads

    def _to_publish(self, loads: list[FileLoad]) -> list[FileLoad]:
        strict = self.cfg.strict_rows_loaded
        return [
            f for f in loads if f.error is None and (f.rows_loaded == f.exp_rows or not strict)
        ]

    def _register(self, loads: list[FileLoad]) -> None:
        """Put the written folders into the catalog; of files with one table the last one stays."""

        def put(f: FileLoad) -> None:
            try:
                self.publisher.put_table(f.table_nm, f.location, f.schema)
            except Exception as error:
                f.fail(error)

        with ThreadPoolExecutor(self.cfg.max_parallel_loads) as pool:
            for wave in waves(self._to_publish(loads)):
                list(pool.map(put, wave))

    def _publish(self, loads: list[FileLoad]) -> list[FileLoad]:
        """Point the views at their newest tables; returns the files whose view is right.

        Files are taken in name order, so each step names the table its view had after it.
        """
        ready = self._to_publish(loads)
        if not ready:
            self.log.flush()
            return []
        opened = utc_now()
        frame = local_frame(
            self.spark,
            [(f.file_nm, n, self._view_label(f)) for f in ready for n in f.row_nos],
            "file_nm string, row_no long, target string",
        )
        self.log.steps(frame, sum(len(f.row_nos) for f in ready), v.VIEW_REFRESH, v.RUNNING, opened, target=F.col("target"))
        self.log.flush()

        newest, shown = self.newest, {}
        for f in ready:
            base, table_nm = _base(f), f.table_nm.upper()
            if table_nm != base:
                newest[base] = max(newest.get(base, ""), table_nm)
            shown[f.file_nm] = newest.get(base)
        errors: dict[str, str] = {}
        for base in {_base(f) for f in ready}:
            try:
                if base not in newest:
                    raise LookupError(f"there is no dated table for the view {base}")
                self.publisher.put_view(base, newest[base])
            except Exception as error:
                errors[base] = _cut(error)
        self.publisher.remember()

        rows = []
        for f in ready:
            problem = errors.get(_base(f))
            message = problem or v.MSG_POINTS_TO.format(table=shown[f.file_nm])
            status = v.ERROR if problem else v.SUCCESS
            rows += [(f.file_nm, n, self._view_label(f), status, message, opened, utc_now()) for n in f.row_nos]
        self._close_steps(v.VIEW_REFRESH, rows)
        return [f for f in ready if _base(f) not in errors]

    def _view_label(self, f: FileLoad) -> str:
        base = names.strip_date(f.table_nm)
        return self.cfg.table_label(f"{self.category}_VW", base)

    def _archive(self, published: list[FileLoad], again: bool = False) -> set[str]:
        """Move the published files to the history folder; returns the paths that moved."""
        if not published:
            return set()
        opened = utc_now()
        history = self.cfg.history(self.category)
        hadoop.make_folder(self.spark, f"{self.cfg.landing_root}/{history}")
        frame = local_frame(self.spark, [(f.file_nm,) for f in published], "file_nm string")
        target = F.concat(F.lit(history), F.col("file_nm"))
        self.log.steps(frame, len(published), v.ARCHIVE, v.RUNNING, opened, target=target)
        self.log.flush()

        def move(f: FileLoad) -> tuple:
            try:
                loaded = f.started if again else None
                ended = archive_file(self.spark, self.cfg, self.category, f.file_nm, loaded)
                message = v.MSG_MOVED_TO.format(folder=history)
                return f.file_nm, 0, history + f.file_nm, v.SUCCESS, message, opened, ended
            except Exception as error:
                return f.file_nm, 0, history + f.file_nm, v.ERROR, _cut(error), opened, utc_now()

        with ThreadPoolExecutor(self.cfg.max_parallel_loads) as pool:
            rows = list(pool.map(move, published))
        self._close_steps(v.ARCHIVE, rows)
        return {f.file_path for f, row in zip(published, rows) if row[3] == v.SUCCESS}

    def _close_steps(self, step: str, rows: list[tuple]) -> None:
        self.log.steps(
            local_frame(self.spark, rows, STEPS),
            len(rows),
            step,
            F.col("status"),
            F.col("started"),
            target=F.col("target"),
            error_msg=F.col("error_msg"),
            ended=F.col("ended"),
        )


def _measured(verdicts: DataFrame, present: Column) -> DataFrame:
    return verdicts.where(present & F.col("error").isNull())


def _passed(verdicts: DataFrame) -> DataFrame:
    return checks.load_gate(verdicts).where(
        (F.col("decision") == "LOAD") & F.col("error").isNull()
    )


def _base(f: FileLoad) -> str:
    return names.strip_date(f.table_nm).upper()


def _cut(error: object) -> str:
    return str(error)[: v.ERROR_TEXT_LENGTH]
