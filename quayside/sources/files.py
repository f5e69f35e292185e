"""Scans of landed files: lines, records and their metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import local_frame
from quayside.sources.visible import Visible

# Comma-separated, one header line, optional double quotes, spaces
# around fields trimmed, unquoted empty fields and \N are NULL, "" is an empty text.
CSV_FORMAT = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "nullValue": "\\N",
    "emptyValue": "",
}

LINES = "line string, file_uri string, block_start long, line_id long"


def _with_position(lines: DataFrame, files: Visible) -> DataFrame:
    return lines.select(
        F.col("value").alias("line"),
        files.uri().alias("file_uri"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def read_lines(
    spark: SparkSession, paths: Sequence[str], line_sep: str | None = None
) -> DataFrame:
    """Physical lines of files, with file, split offset and an id that keeps line order.

    ``line_id`` grows along a split, and the split at offset 0 starts a file.
    """
    if not paths:
        return local_frame(spark, [], LINES)
    files = Visible(spark, paths)
    return _with_position(spark.read.options(**files.options).text(files.paths, lineSep=line_sep), files)


def read_records(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, **options: str
) -> DataFrame:
    """Data records of files whose records each fit on a line, plus ``file_uri``."""
    files = Visible(spark, paths)
    reader = spark.read.schema(schema).options(**{"header": "true", **CSV_FORMAT, **options}, **files.options)
    return reader.csv(files.paths).select("*", files.uri().alias("file_uri"))


def text_schema(width: int) -> T.StructType:
    """All columns as text, and the whole record where its width differs."""
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(width)]
    return T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])


def rows_per_file(rows: DataFrame, path_pattern: str) -> DataFrame:
    """Rows per file of any scan that carries ``file_path``, for paths that match as a whole."""
    return (
        rows.where(F.col("file_path").rlike(f"^(?:{path_pattern})$"))
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("actual_row_cnt"))
    )
