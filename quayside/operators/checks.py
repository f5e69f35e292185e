"""Checks of files against the manifest, the verdict and the load gate.

All frames hold one row per file with ``file_nm``, ``n_listed`` (manifest rows of that
name), the promised ``exp_cols`` / ``exp_rows`` and the measured ``act_cols`` / ``act_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import vocabulary as v
from quayside.functions.names import file_key

AUDIT_FIELDS = ("file_nm", "check_nm", "expected_val", "actual_val", "check_status", "check_msg")


def listed() -> Column:
    return F.col("n_listed") > 0


def manifest_lookup(manifest: DataFrame) -> DataFrame:
    """Manifest by file key; rows that name a file twice collapse to the larger counts."""
    return manifest.groupBy(file_key("file_nm").alias("file_key")).agg(
        F.count(F.lit(1)).alias("n_listed"),
        F.max("col_cnt").alias("exp_cols"),
        F.max("row_cnt").alias("exp_rows"),
    )


def look_up(files: DataFrame, lookup: DataFrame) -> DataFrame:
    """Files with what the manifest promises about them, in one join for all files."""
    return (
        files.withColumn("file_key", file_key("file_nm"))
        .join(lookup, "file_key", "left")
        .withColumn("n_listed", F.coalesce("n_listed", F.lit(0)))
        .drop("file_key")
    )


def _audit(rows: DataFrame, **fields: Column) -> DataFrame:
    return rows.select("file_nm", *(fields[name].alias(name) for name in AUDIT_FIELDS[1:]))


def presence_check(
    files: DataFrame, check_nm: str, present: Column, yes: Column, no: Column
) -> DataFrame:
    """A Y/N check: expected is always Y."""
    return _audit(
        files,
        check_nm=F.lit(check_nm),
        expected_val=F.lit("Y"),
        actual_val=F.when(present, "Y").otherwise("N"),
        check_status=F.when(present, v.PASS).otherwise(v.FAIL),
        check_msg=F.when(present, yes).otherwise(no),
    )


def in_manifest_check(files: DataFrame, manifest_name: str) -> DataFrame:
    return presence_check(
        files,
        v.FILE_IN_INVENTORY,
        listed(),
        F.lit(v.MSG_IN_MANIFEST.format(manifest=manifest_name)),
        F.lit(v.MSG_NOT_IN_MANIFEST.format(manifest=manifest_name)),
    )


def count_checks(files: DataFrame) -> DataFrame:
    """COLUMN_COUNT and ROW_COUNT of each file in one pass; NULL equals only NULL."""
    one = F.array(
        *(
            F.struct(
                F.lit(check).alias("check_nm"),
                F.col(expected).cast("long").cast("string").alias("expected_val"),
                F.col(actual).cast("long").cast("string").alias("actual_val"),
                F.when(F.col(expected).eqNullSafe(F.col(actual)), v.PASS)
                .otherwise(v.FAIL)
                .alias("check_status"),
                F.lit(message).alias("check_msg"),
            )
            for check, expected, actual, message in (
                (v.COLUMN_COUNT, "exp_cols", "act_cols", v.MSG_COLUMN_COUNT),
                (v.ROW_COUNT, "exp_rows", "act_rows", v.MSG_ROW_COUNT),
            )
        )
    )
    return files.select("file_nm", F.inline(one))


def skipped_checks(files: DataFrame, message: str) -> DataFrame:
    """The count checks of files that cannot be measured."""
    nothing = F.lit(None).cast("string")
    return _audit(
        files.withColumn("check_nm", F.explode(F.array(F.lit(v.COLUMN_COUNT), F.lit(v.ROW_COUNT)))),
        check_nm=F.col("check_nm"),
        expected_val=nothing,
        actual_val=nothing,
        check_status=F.lit(v.SKIPPED),
        check_msg=F.lit(message),
    )


def verdict(files: DataFrame, present: Column) -> DataFrame:
    """Adds ``n_failed``: 1 for an absent file, else the number of differing counts."""
    differs = [
        (~F.col(e).eqNullSafe(F.col(a))).cast("int")
        for e, a in (("exp_cols", "act_cols"), ("exp_rows", "act_rows"))
    ]
    return files.withColumn("n_failed", F.when(~present, 1).otherwise(differs[0] + differs[1]))


def validation_outcome(verdicts: DataFrame) -> DataFrame:
    """Closing status and message of the validation step."""
    passed = F.col("n_failed") == 0
    return verdicts.withColumn(
        "status", F.when(passed, v.SUCCESS).otherwise(v.FAILED)
    ).withColumn(
        "error_msg",
        F.when(~passed, F.concat(F.col("n_failed").cast("string"), F.lit(v.MSG_CHECKS_FAILED))),
    )


def load_gate(verdicts: DataFrame) -> DataFrame:
    """LOAD for files without a failed check, SKIPPED for all others."""
    return verdicts.withColumn(
        "decision", F.when(F.col("n_failed") == 0, "LOAD").otherwise(v.SKIPPED)
    )


def rows_loaded_check(loads: DataFrame, table_label: Column) -> DataFrame:
    """Rows loaded against rows promised; a missing promise never passes."""
    return _audit(
        loads,
        check_nm=F.lit(v.ROWS_LOADED),
        expected_val=F.col("exp_rows").cast("long").cast("string"),
        actual_val=F.col("rows_loaded").cast("string"),
        check_status=F.when(F.col("rows_loaded") == F.col("exp_rows"), v.PASS).otherwise(v.FAIL),
        check_msg=F.concat(F.lit(v.MSG_ROWS_LOADED.format(table="")), table_label),
    )


def loaded_before(
    job_events: DataFrame, category: str | None = None, wanted: DataFrame | None = None
) -> DataFrame:
    """File keys with a successful load in the step log, only those of ``wanted`` files if given.

    A successful load step is never reopened, so its closing event alone decides and the
    filter reaches the scan. The history is cut to the wanted keys before anything is shuffled.
    """
    done = (F.col("step_nm") == v.TABLE_LOAD) & (F.col("status") == v.SUCCESS)
    if category is not None:
        done = done & (F.col("category") == category)
    keys = job_events.where(done).select(file_key("file_nm").alias("file_key"))
    if wanted is not None:
        keys = keys.join(wanted.select(file_key("file_nm").alias("file_key")), "file_key", "left_semi")
    return keys.distinct()


def not_in_folder(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows whose file is not in the folder, with their file key."""
    present = files.select(file_key("file_nm").alias("file_key"))
    return manifest.withColumn("file_key", file_key("file_nm")).join(present, "file_key", "left_anti")


def missing_files(manifest: DataFrame, files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Manifest rows whose file is not in the folder and was never loaded."""
    return not_in_folder(manifest, files).join(loaded, "file_key", "left_anti").drop("file_key")


def manifest_presence(
    manifest: DataFrame, files: DataFrame, key: Column, *carry: str
) -> DataFrame:
    """Manifest rows with ``n_found``, the files of the same key that are there.

    ``carry`` names file columns to bring along.
    """
    found = files.groupBy(key.alias("found_key")).agg(
        F.count(F.lit(1)).alias("n_found"), *(F.max(name).alias(name) for name in carry)
    )
    return (
        manifest.join(found, key == F.col("found_key"), "left")
        .withColumn("n_found", F.coalesce("n_found", F.lit(0)))
        .drop("found_key")
    )


def missing_audit(missing: DataFrame, folder: str) -> DataFrame:
    return presence_check(
        missing,
        v.FILE_NAME_EXISTS,
        F.lit(False),
        F.lit(None).cast("string"),
        F.lit(v.MSG_AUDIT_MISSING.format(folder=folder)),
    )


def run_summary(outcomes: DataFrame, missing: DataFrame) -> DataFrame:
    """The five counters of a run from one row per found file.

    ``outcomes`` has ``listed``, ``loaded`` and ``failed``.
    """
    found = outcomes.select("listed", "loaded", "failed", F.lit(True).alias("found"))
    absent = missing.select(F.lit(False).alias("found"))
    return found.unionByName(absent, allowMissingColumns=True).agg(
        F.count_if("found").alias("files_found"),
        F.count_if("loaded").alias("files_loaded"),
        F.count_if("failed").alias("files_failed"),
        F.count_if(F.col("found") & ~F.col("listed")).alias("files_not_in_inventory"),
        F.count_if(~F.col("found")).alias("files_missing"),
    )
