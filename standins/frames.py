"""The given tables dressed as manifests, landed files, logs and listings.

Days with an urgent order are announced in the manifest. A day is delivered if one of
its shipments is large, and a day without tiny shipments lacks a column. So there are
listed and unlisted, missing, short and good files, whole tables are read, and the
reductions stay aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

URGENT = "1-URGENT"
LARGE, TINY = 45, 3
STEP_OF_EVENT = {
    "signup": "VALIDATION",
    "purchase": "TABLE_LOAD",
    "view": "VIEW_REFRESH",
    "click": "ARCHIVE",
    "error": "FILE_MISSING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderdate")
        .agg(F.count(F.lit(1)).alias("row_cnt"), F.count_if(F.col("o_orderpriority") == URGENT).alias("u"))
    )
    return per_day.where("u > 0").select(
        F.concat(F.lit("SALES_"), day("o_orderdate"), F.lit(".csv")).alias("file_nm"),
        F.lit(11).alias("col_cnt"),
        "row_cnt",
    )


def repeated_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest that names a day once per order status, in two spellings."""
    rows = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderdate", "o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("row_cnt"),
            F.count_if(F.col("o_totalprice") > 100000).alias("col_cnt"),
        )
    )
    prefix = F.when(F.col("o_orderstatus") == "F", "sales_").otherwise("SALES_")
    return rows.select(
        F.concat(prefix, day("o_orderdate"), F.lit(".csv")).alias("file_nm"), "col_cnt", "row_cnt"
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"))
    )
    per_day = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderdate")
        .join(shipped, "o_orderkey")
        .groupBy("o_orderdate")
        .agg(
            F.count(F.lit(1)).alias("act_rows"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
        )
    )
    return per_day.where(F.col("most") > LARGE).select(
        F.concat(F.lit("sales_"), day("o_orderdate"), F.lit(".CSV")).alias("file_nm"),
        F.when(F.col("least") > TINY, 10).otherwise(11).alias("act_cols"),
        "act_rows",
    )


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments as log events: a returned full box counts as a successful load of its day."""
    success = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 50)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("sales_"), day("l_shipdate"), F.lit(".csv")).alias("file_nm"),
        F.lit("TABLE_LOAD").alias("step_nm"),
        F.when(success, "SUCCESS").otherwise("FAILED").alias("status"),
    )


def step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log steps; the status follows from the value."""
    kind, value = F.col("event_type"), F.col("value")
    step = F.lit(None).cast("string")
    for event, name in STEP_OF_EVENT.items():
        step = F.when(kind == event, name).otherwise(step)
    running = value < 10
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("job_run_id"),
        F.concat(F.lit("FILE_"), day("ts")).alias("file_nm"),
        step.alias("step_nm"),
        F.when(running, "RUNNING")
        .when(value < 30, "SUCCESS")
        .when(value < 60, "FAILED")
        .otherwise("SKIPPED")
        .alias("status"),
        F.col("event_id").alias("row_cnt"),
        kind.alias("target_object"),
        F.col("props").alias("error_msg"),
        F.col("ts").alias("start_ts"),
        F.when(~running, F.col("ts")).alias("end_ts"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file, every line of it as a scanned line."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_uri"),
        F.lit(0).alias("block_start"),
        F.posexplode(F.split("text", "\n")).alias("line_id", "line"),
    )


def order_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of dated tables, one per status and day."""
    return table(spark, sf_dir, "orders").withColumn(
        "table_nm", F.concat(F.lit("ORD_"), "o_orderstatus", F.lit("_"), day("o_orderdate"))
    )
