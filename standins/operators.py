"""One query per operator: the library's operators over the frames of ``frames``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import names
from quayside.operators import checks, latest, lineage, measure, monitor, profile, steplog
from quayside.sources.files import rows_per_file
from quayside.sources.folder import waiting_files
from quayside.sources.manifest import parse_manifest
from standins import frames

MANIFEST_NAME = "RDS_Inventory_SALES.csv"
LOADED_AT = datetime(2024, 1, 1)


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = checks.manifest_lookup(frames.manifest(spark, sf_dir))
    files = checks.look_up(frames.landed(spark, sf_dir), lookup)
    return checks.verdict(files, checks.listed())


def manifest_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    written = (
        F.when(F.col("p_brand") == "Brand#1", "N/A")
        .when(F.col("p_type") == "ECONOMY", F.concat(size, F.lit(".5")))
        .when(F.col("p_type") == "PROMO", "")
        .otherwise(F.concat(F.lit("  "), size, F.lit(" ")))
    )
    raw = frames.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit(" "), F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_name"))).alias(
            "file_nm"
        ),
        F.col("p_brand").alias("col_cnt"),
        written.alias("row_cnt"),
    )
    return parse_manifest(raw).select("p_partkey", "file_nm", "col_cnt", "row_cnt")


def folder_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = frames.table(spark, sf_dir, "pages")
    listing = pages.select("page_id", F.col("url").alias("relative_path"))
    return waiting_files(listing, "http", "http://", "rds_inventory").select(
        "page_id", "file_nm", "relative_path"
    )


def inventory_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.manifest_lookup(frames.repeated_manifest(spark, sf_dir))


def check_file_in_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.in_manifest_check(_verdicts(spark, sf_dir), MANIFEST_NAME)


def check_column_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = measure.measure_lines(frames.document_lines(spark, sf_dir))
    return measured.select(F.col("file_uri").alias("doc_id"), "act_cols")


def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = measure.measure_lines(frames.document_lines(spark, sf_dir))
    return measured.select(F.col("file_uri").alias("doc_id"), "act_rows")


def audit_count_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.count_checks(_verdicts(spark, sf_dir).where(checks.listed()))


def audit_skipped_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    unlisted = _verdicts(spark, sf_dir).where(~checks.listed())
    skipped = checks.skipped_checks(unlisted, "File not in inventory")
    return skipped.select("file_nm", "check_nm", "check_status", "check_msg")


def validation_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = checks.validation_outcome(_verdicts(spark, sf_dir))
    return closed.select("file_nm", "status", "error_msg")


def load_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.load_gate(_verdicts(spark, sf_dir)).select("file_nm", "decision")


def check_rows_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivered day as if it were loaded; days that nobody promised never pass."""
    loads = _verdicts(spark, sf_dir).withColumnRenamed("act_rows", "rows_loaded")
    checked = checks.rows_loaded_check(loads, names.table_name("file_nm"))
    return checked.select("file_nm", "expected_val", "actual_val", "check_status", "check_msg")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = F.col("n_failed") == 0
    outcomes = _verdicts(spark, sf_dir).select(
        checks.listed().alias("listed"),
        passed.alias("loaded"),
        (checks.listed() & ~passed).alias("failed"),
    )
    nothing_loaded = checks.loaded_before(frames.load_history(spark, sf_dir).where("false"))
    missing = checks.missing_files(
        frames.manifest(spark, sf_dir), frames.landed(spark, sf_dir), nothing_loaded
    )
    return checks.run_summary(outcomes, missing)


def file_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.missing_files(
        frames.manifest(spark, sf_dir),
        frames.landed(spark, sf_dir),
        checks.loaded_before(frames.load_history(spark, sf_dir)),
    ).select("file_nm")


def inventory_driven_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.manifest_presence(
        frames.manifest(spark, sf_dir), frames.landed(spark, sf_dir), names.file_key("file_nm")
    )
    return found.select(
        "file_nm", F.when(F.col("n_found") > 0, "PASS").otherwise("FAIL").alias("check_status")
    )


def table_and_base_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_nm = F.upper(names.table_name("file_nm"))
    return frames.landed(spark, sf_dir).select(
        "file_nm", table_nm.alias("table_nm"), names.base_name(table_nm).alias("base_nm")
    )


def latest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_tables(frames.order_tables(spark, sf_dir))


def view_over_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = frames.order_tables(spark, sf_dir)
    return latest.rows_of_latest(tables, latest.latest_tables(tables))


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineage.with_lineage(
        frames.table(spark, sf_dir, "customer"),
        F.lit("CRM/CUSTOMER_20240101.csv"),
        F.lit(LOADED_AT).cast("timestamp_ntz"),
    )
    return rows.withColumnsRenamed({"SRC_FILE_NM": "src_file_nm", "LOAD_TS": "load_ts"})


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.load_summary(frames.step_log(spark, sf_dir), ("job_run_id", "file_nm"))


def step_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steplog.current_state(
        frames.step_log(spark, sf_dir), "seq", ("status", "row_cnt", "error_msg", "end_ts")
    )


def error_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = frames.step_log(spark, sf_dir).withColumn("error_msg", F.repeat("error_msg", F.lit(200)))
    return steplog.finish_with_error(steps).select("seq", "status", "error_msg")


def failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = checks.count_checks(_verdicts(spark, sf_dir).where(checks.listed())).withColumns(
        {
            "job_run_id": F.lit("r"),
            "category": F.lit("SALES"),
            "checked_at": F.lit(LOADED_AT).cast("timestamp_ntz"),
        }
    )
    return monitor.failed_checks(audit)


def per_file_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = frames.table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("/"), "lang").alias("file_path")
    )
    return rows_per_file(scanned, "src[0-9]{1,2}/[a-z]+")


def _profiled_parts(spark: SparkSession, sf_dir: str) -> tuple[list[str], DataFrame]:
    part = frames.table(spark, sf_dir, "part").withColumn(
        "p_retailprice", F.col("p_retailprice").cast("decimal(12,2)")
    )
    texts = part.select(*(F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(part.columns)))
    rows = texts.withColumns({"file_uri": F.lit("part"), "_corrupt_record": F.lit(None).cast("string")})
    values = profile.column_values(rows, len(part.columns))
    return part.columns, profile.profile_values(values, "file_uri", "pos")


def schema_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns, profiled = _profiled_parts(spark, sf_dir)
    named = profiled.withColumn("column_type", profile.column_type()).withColumn(
        "name", F.element_at(F.array(*map(F.lit, columns)), F.col("pos") + 1)
    )
    return profile.schema_template(named, "name", "pos")


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, profiled = _profiled_parts(spark, sf_dir)
    return profiled.select("pos", "kinds", "whole_digits", "scale")


def current_view_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.left("o_orderpriority", F.lit(1))
    registry = frames.table(spark, sf_dir, "orders").select(
        F.when(status == "F", "hds_vw").when(status == "O", "ihp_vw").otherwise("ops").alias(
            "view_schema"
        ),
        F.concat(F.lit("ORD_"), priority).alias("view_name"),
        F.concat(F.lit("ORD_"), priority, F.lit("_"), frames.day("o_orderdate")).alias("points_to"),
        F.col("o_orderdate").alias("refreshed_at"),
    )
    return monitor.current_view_source(registry, ["hds_vw", "ihp_vw"])


QUERIES = {
    f.__name__: f
    for f in (
        manifest_parse,
        folder_listing,
        inventory_lookup,
        check_file_in_inventory,
        check_column_count,
        check_row_count,
        audit_count_checks,
        audit_skipped_checks,
        validation_step,
        load_gate,
        check_rows_loaded,
        run_summary,
        file_missing,
        inventory_driven_exists,
        table_and_base_name,
        latest_table,
        view_over_latest,
        lineage_columns,
        load_summary,
        step_current_state,
        error_finalize,
        failed_checks,
        per_file_profile,
        schema_template,
        column_profile,
        current_view_source,
    )
}
