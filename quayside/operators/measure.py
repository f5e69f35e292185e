"""Column and row counts of landed files, all files in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import names, text
from quayside.session import written
from quayside.sources import quoted
from quayside.sources.files import read_lines

MEASURES = (
    "file_path string, act_cols int, act_rows long, header_key long, header_open boolean, "
    "broken_lines boolean, unclosed boolean"
)


def measure_lines(lines: DataFrame) -> DataFrame:
    """Per file: columns of the first line that is not blank, data lines, header fingerprint, open quotes.

    Every buffer has a fixed width, so this stays a hash aggregate with one small row
    per file and split going through the shuffle, however large a single file is.
    """
    at_top = F.when(F.col("block_start") == 0, F.col("line_id"))
    blank = text.is_blank("line")
    at_header = F.when(~blank, at_top)
    runs_on = text.open_after("line")
    measured = lines.groupBy("file_uri").agg(
        F.min_by(F.when(at_header.isNotNull(), text.column_count("line")), at_header).alias("act_cols"),
        F.count_if(~blank).alias("n_lines"),
        F.min_by(F.xxhash64("line"), at_header).alias("header_key"),
        F.min_by(runs_on, at_header).alias("header_open"),
        F.max(runs_on).alias("broken_lines"),
    )
    return measured.select(
        "file_uri",
        F.coalesce("act_cols", F.lit(0)).alias("act_cols"),
        F.greatest(F.col("n_lines") - 1, F.lit(0)).alias("act_rows"),
        "header_key",
        "header_open",
        "broken_lines",
    )


def measure_files(
    spark: SparkSession, paths: Sequence[str], scratch: str
) -> tuple[DataFrame, quoted.QuotedRecords | None]:
    """Measures of files, plus the numbered records of files with line breaks in fields.

    Files without any line that leaves a quote open are done after one scan.
    """
    by_line = written(measure_lines(read_lines(spark, paths)), scratch)
    broken = by_line.where("broken_lines").select(names.decoded("file_uri").alias("p"))
    broken_paths = [row.p for row in broken.collect()]
    records = quoted.quoted_records(spark, broken_paths, scratch) if broken_paths else None
    if records is None:
        measured = by_line.withColumn("unclosed", F.lit(False))
    else:
        exact = quoted.record_counts(records)
        measured = (
            by_line.join(exact, "file_uri", "left")
            .withColumn("act_rows", F.coalesce("records", "act_rows"))
            .withColumn("unclosed", F.coalesce("unclosed", F.lit(False)))
            .drop("records")
        )
    return measured.select(
        names.decoded("file_uri").alias("file_path"),
        "act_cols",
        "act_rows",
        "header_key",
        "header_open",
        "broken_lines",
        "unclosed",
    ), records


def with_measures(files: DataFrame, measures: DataFrame) -> DataFrame:
    """Files with their measures; a file that yields no line measures 0 and 0."""
    return (
        files.join(measures, "file_path", "left")
        .withColumn("act_cols", F.coalesce("act_cols", F.lit(0)))
        .withColumn("act_rows", F.coalesce("act_rows", F.lit(0)))
    )
