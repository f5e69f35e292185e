"""The step log: events are appended, the current state is read by reducing them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside import vocabulary as v

STEP_KEY = ("job_run_id", "file_nm", "step_nm")
# row_no tells manifest rows apart that repeat a file name; a run driven by the folder has one row per file
EVENT_SCHEMA = (
    "event_id long, job_run_id string, job_nm string, category string, file_nm string, "
    "step_nm string, target_object string, status string, row_cnt long, error_msg string, "
    "start_ts timestamp, end_ts timestamp, created_by string, row_no long"
)


def current_state(
    events: DataFrame,
    seq: str,
    latest: tuple[str, ...],
    keys: tuple[str, ...] = STEP_KEY,
) -> DataFrame:
    """One row per step: first start, and the other fields as its newest event has them."""
    newest = F.max_by(F.struct(*latest), seq)
    reduced = events.groupBy(*keys).agg(
        F.min(seq).alias("first_seq"), F.min("start_ts").alias("start_ts"), newest.alias("now")
    )
    return reduced.select("first_seq", *keys, "start_ts", "now.*")


def job_log(events: DataFrame, with_row: bool = False) -> DataFrame:
    """The job log: one row per run, file and step, and for each manifest row that a run walks."""
    state = current_state(
        events.withColumn("row_no", F.coalesce("row_no", F.lit(0))),
        "event_id",
        ("job_nm", "category", "target_object", "status", "row_cnt", "error_msg", "end_ts", "created_by"),
        (*STEP_KEY, "row_no"),
    )
    return state.select(
        F.col("first_seq").alias("job_log_id"),
        "job_run_id",
        "job_nm",
        "category",
        "file_nm",
        "step_nm",
        "target_object",
        "status",
        "row_cnt",
        "error_msg",
        "start_ts",
        "end_ts",
        "created_by",
        *(["row_no"] if with_row else []),
    )


def finish_with_error(steps: DataFrame) -> DataFrame:
    """Steps still running end as errors, with the message cut to its stored length."""
    running = F.col("status") == v.RUNNING
    return steps.withColumn(
        "error_msg",
        F.when(running, F.left("error_msg", F.lit(v.ERROR_TEXT_LENGTH))).otherwise(
            F.col("error_msg")
        ),
    ).withColumn("status", F.when(running, v.ERROR).otherwise(F.col("status")))
