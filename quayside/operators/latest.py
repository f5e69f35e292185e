"""The newest dated table behind each view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import names


def latest_tables(tables: DataFrame) -> DataFrame:
    """Newest dated table per base name; names without a date are no candidates.

    Eight digits order alike as text and as a number, and a number keeps the aggregate
    in fixed-width buffers.
    """
    newest = F.max(F.right("table_nm", F.lit(8)).cast("int"))
    return (
        tables.where(names.is_dated("table_nm"))
        .groupBy(names.base_name("table_nm").alias("base_nm"))
        .agg(newest.alias("newest"))
        .select(
            "base_nm",
            F.concat("base_nm", F.lit("_"), F.lpad(F.col("newest").cast("string"), 8, "0")).alias(
                "latest_table"
            ),
        )
    )


def rows_of_latest(rows: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows whose ``table_nm`` is the newest of its base: what the views serve."""
    newest = latest.select(F.col("latest_table").alias("table_nm"))
    return rows.join(newest, "table_nm", "left_semi").drop("table_nm")
