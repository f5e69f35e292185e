"""Monitoring views over the logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import vocabulary as v
from quayside.functions.values import seconds_between


def load_summary(
    job_log: DataFrame, keys: Sequence[str] = ("job_run_id", "category", "file_nm")
) -> DataFrame:
    """One row per file and run, the steps side by side."""

    def at(step: str, field: str) -> Column:
        return F.max(F.when(F.col("step_nm") == step, F.col(field)))

    summary = job_log.groupBy(*keys).agg(
        at(v.VALIDATION, "status").alias("validation_status"),
        at(v.TABLE_LOAD, "status").alias("load_status"),
        at(v.TABLE_LOAD, "row_cnt").alias("rows_loaded"),
        at(v.TABLE_LOAD, "target_object").alias("target_table"),
        at(v.VIEW_REFRESH, "status").alias("view_status"),
        at(v.VIEW_REFRESH, "target_object").alias("target_view"),
        at(v.ARCHIVE, "status").alias("archive_status"),
        at(v.FILE_MISSING, "status").alias("missing_status"),
        F.max("error_msg").alias("error_msg"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
    )
    return summary.withColumn("duration_sec", seconds_between("start_ts", "end_ts"))


def earlier_load_summary(job_log: DataFrame) -> DataFrame:
    """The summary as it was before archiving and missing files were logged."""
    return load_summary(job_log).drop("archive_status", "missing_status")


def failed_checks(audit_log: DataFrame) -> DataFrame:
    return audit_log.where(F.col("check_status") == v.FAIL).select(
        "job_run_id",
        "category",
        "file_nm",
        "check_nm",
        "expected_val",
        "actual_val",
        "check_msg",
        "checked_at",
    )


def current_view_source(registry: DataFrame, schemas: Sequence[str]) -> DataFrame:
    """Which dated table each published view serves, and since when."""
    return (
        registry.where(F.col("view_schema").isin(*schemas))
        .groupBy("view_schema", "view_name")
        .agg(
            F.max_by("points_to", "refreshed_at").alias("points_to"),
            F.max("refreshed_at").alias("last_refreshed"),
        )
    )
