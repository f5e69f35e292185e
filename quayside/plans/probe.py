"""Ad-hoc looks at files in place, without loading them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.measure import measure_files, with_measures
from quayside.session import new_folder
from quayside.sources.folder import list_folder


def matching_files(spark: SparkSession, root: str, path_pattern: str) -> DataFrame:
    """The listing of a root, for files whose whole path below it matches a pattern."""
    return list_folder(spark, root).where(F.col("relative_path").rlike(f"^(?:{path_pattern})$"))


def probe_files(spark: SparkSession, root: str, path_pattern: str) -> DataFrame:
    """Actual column and row counts of every matching file."""
    files = matching_files(spark, root, path_pattern)
    paths = [row.file_path for row in files.select("file_path").collect()]
    measures, _ = measure_files(spark, paths, new_folder(spark, "probe"))
    return with_measures(files, measures).select(
        "file_path",
        F.col("act_cols").alias("actual_col_cnt"),
        F.col("act_rows").alias("actual_row_cnt"),
    )
