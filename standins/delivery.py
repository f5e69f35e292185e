"""Deliveries made from the given tables, run through the whole intake."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import IntakeConfig, load_category
from quayside.functions import names
from quayside.operators import monitor
from quayside.plans.load import WRITE_SETTINGS
from quayside.plans.oplog import OpsStore
from quayside.plans.probe import probe_files
from quayside.session import local_frame, new_folder
from quayside.sources import hadoop
from quayside.sources.catalog import entries
from quayside.sources.folder import list_folder
from quayside.sources.manifest import read_all_manifests
from standins.frames import table

#: Bytes of text in a file that spreads a table: its writer, and whoever reads it whole, is one task.
FILE_BYTES = 1 << 28
FEWEST = 3
FIRST_DAY = date(2000, 1, 1)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """A session with other settings for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def dealt(texts: DataFrame, stamps: list[str]) -> DataFrame:
    """Rows with each stamp in a partition of its own; rows without one are in the first."""
    known = F.array(*map(F.lit, stamps)).cast("array<string>")
    own = F.coalesce(F.array_position(known, F.col("stamp")), F.lit(0)).cast("int")
    return texts.repartitionById(len(stamps) + 1, own)


class Delivery:
    """A landing zone of its own, with one category."""

    def __init__(self, spark: SparkSession):
        root = new_folder(spark, "delivery")
        self.spark = spark
        self.category = f"D{uuid.uuid4().hex[:8].upper()}"
        self.cfg = IntakeConfig(f"{root}/landing", f"{root}/store", ops_db=f"{self.category}_ops")
        self.parts = f"{root}/parts"
        self.folder = f"{self.cfg.landing_root}/{self.category}"
        self.counts: list[DataFrame] = []

    def put(
        self, feed: str, df: DataFrame, stamp: Column, quote_all: bool = False, **options: str
    ) -> None:
        """Write a frame as files ``<feed>_<stamp>.csv``, one writer per stamp, which sorts nothing."""
        texts = df.select(*(F.col(c).cast("string").alias(c) for c in df.columns), stamp.alias("stamp"))
        counts = texts.groupBy("stamp").count().collect()
        rows = [(r["stamp"] and f"{feed}_{r['stamp']}.csv", len(df.columns), r["count"]) for r in counts]
        self.counts.append(local_frame(self.spark, rows, "file_nm string, col_cnt int, row_cnt long"))
        target = f"{self.parts}/{feed}"
        with settings(df.sparkSession, WRITE_SETTINGS):
            (
                dealt(texts, sorted(r["stamp"] for r in counts if r["stamp"] is not None))
                .write.partitionBy("stamp")
                .options(header=True, escape='"', quoteAll=quote_all, nullValue="\\N")
                .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
                .options(**options)
                .csv(target)
            )
        hadoop.make_folder(self.spark, self.folder)
        for part, _, _ in hadoop.walk(self.spark, target):
            if part.endswith(".csv"):
                stamped = part.split("/")[0].removeprefix("stamp=")
                whole = f"{self.folder}/{feed}_{stamped}.csv"
                if hadoop.exists(self.spark, whole):
                    raise RuntimeError(f"{whole} was written in more than one part")
                hadoop.move(self.spark, f"{target}/{part}", whole)

    def announce(self, manifest: DataFrame | None = None) -> None:
        """Write the manifest: what was put, or other rows of the same shape."""
        rows = manifest if manifest is not None else reduce(DataFrame.unionByName, self.counts)
        rows = rows.withColumn("date", F.current_date()).withColumn("owner", F.lit("TESTS"))
        target = f"{self.parts}/manifest"
        rows.repartition(1).write.option("header", True).csv(target)
        for part, _, _ in hadoop.walk(self.spark, target):
            if part.endswith(".csv"):
                name = self.cfg.manifest_name(self.category)
                hadoop.move(self.spark, f"{target}/{part}", f"{self.folder}/{name}")

    def load(self, driven_by: str = "folder") -> DataFrame:
        return load_category(self.spark, self.cfg, self.category, driven_by)

    @property
    def store(self) -> OpsStore:
        return OpsStore(self.spark, self.cfg)

    def landed(self) -> list[str]:
        """Paths of the delivered files."""
        found = [name for name, _, _ in hadoop.walk(self.spark, self.folder)]
        return [f"{self.folder}/{n}" for n in found if not n.startswith(self.cfg.manifest_prefix)]

    def dated_tables(self) -> list[DataFrame]:
        lineage = ("SRC_FILE_NM", "LOAD_TS")
        found = [t.name for t in entries(self.spark, self.category)]
        return [self.spark.table(f"{self.category}.{n}").drop(*lineage) for n in sorted(found)]

    def view(self, feed: str) -> DataFrame:
        served = self.spark.table(f"{self.category}_VW.{feed}")
        return served.drop("SRC_FILE_NM", "LOAD_TS")


def spread(source: DataFrame, key: str) -> Column:
    """Stamps that spread a table over files of about FILE_BYTES of text, however well it is compressed."""
    width = reduce(Column.__add__, (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(2)) + 1 for c in source.columns))
    size = source.agg(F.sum(width.cast("long"))).first()[0] or 0
    n_files = max(FEWEST, math.ceil(size / FILE_BYTES))
    offset = F.pmod(F.xxhash64(key), F.lit(n_files)).cast("int")
    return F.date_format(F.date_add(F.lit(FIRST_DAY), offset), "yyyyMMdd")


def cast_like(df: DataFrame, source: DataFrame) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in source.schema))


def round_trip(spark: SparkSession, sf_dir: str, name: str, key: str, quote_all: bool = False) -> DataFrame:
    """A table delivered as CSV files, loaded, and read back from its dated tables."""
    source = table(spark, sf_dir, name)
    delivery = Delivery(spark)
    delivery.put(name.upper(), source, spread(source, key), quote_all)
    delivery.announce()
    delivery.load()
    tables = [cast_like(t, source) for t in delivery.dated_tables()]
    return reduce(DataFrame.unionByName, tables)


def orders_by_year(spark: SparkSession, sf_dir: str) -> Delivery:
    """Orders delivered and loaded as one file per year."""
    delivery = Delivery(spark)
    orders = table(spark, sf_dir, "orders")
    delivery.put("ORDERS", orders, F.date_format(F.trunc("o_orderdate", "year"), "yyyyMMdd"))
    delivery.announce()
    delivery.load()
    return delivery


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the consumption view serves: the newest year."""
    view = orders_by_year(spark, sf_dir).view("ORDERS")
    return cast_like(view, table(spark, sf_dir, "orders"))


def orders_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = orders_by_year(spark, sf_dir).store.audit_log()
    return audit.select("file_nm", "check_nm", "expected_val", "actual_val", "check_status")


def orders_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = orders_by_year(spark, sf_dir).store.load_summary()
    return summary.select(
        "file_nm",
        "validation_status",
        "load_status",
        "rows_loaded",
        "view_status",
        "archive_status",
        "missing_status",
        "error_msg",
    )


def late_years(orders: DataFrame) -> DataFrame:
    """A manifest that announces each year with the number of orders of the year before."""
    stamp = F.date_format(F.trunc(F.add_months("o_orderdate", 12), "year"), "yyyyMMdd")
    return (
        orders.groupBy(stamp.alias("stamp"))
        .agg(F.count(F.lit(1)).alias("row_cnt"))
        .select(
            F.concat(F.lit("ORDERS_"), "stamp", F.lit(".csv")).alias("file_nm"),
            F.lit(len(orders.columns)).alias("col_cnt"),
            "row_cnt",
        )
    )


def rejected(spark: SparkSession, sf_dir: str) -> Delivery:
    """Orders by year with a manifest a year late: unlisted, differing and missing files."""
    delivery = Delivery(spark)
    orders = table(spark, sf_dir, "orders")
    delivery.put("ORDERS", orders, F.date_format(F.trunc("o_orderdate", "year"), "yyyyMMdd"))
    delivery.announce(late_years(orders))
    return delivery


def rejected_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(spark, sf_dir).load().drop("job_run_id", "category")


def rejected_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = rejected(spark, sf_dir)
    delivery.load()
    failed = delivery.store.failed_checks()
    return failed.select("file_nm", "check_nm", "expected_val", "actual_val")


def with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of a run over good files, two of them with names that readers hide, and over bad ones: records of
    the wrong width that hold names of errors, a blank column name beside one that names an error, and no date."""
    delivery = Delivery(spark)
    year = F.date_format(F.trunc("o_orderdate", "year"), "yyyyMMdd")
    delivery.put("ORDERS", table(spark, sf_dir, "orders"), year)
    wide = F.when(F.col("n_regionkey") == 0, F.concat("n_name", F.lit(",OutOfMemoryError"))).otherwise(F.col("n_name"))
    ragged = table(spark, sf_dir, "nation").select("n_nationkey", wide.alias("n_name"))
    delivery.put("NATION", ragged, F.lit("20000101"), quote="")
    region = table(spark, sf_dir, "region")
    delivery.put("REGION", region, F.lit("ALL"))
    named = region.select("*", F.col("r_name").alias("cancelled_at")).toDF("id", " ", "cancelled_at")
    delivery.put("CANCELLED", named, F.lit("20000101"))
    delivery.put("_SUPPLIER", table(spark, sf_dir, "supplier"), F.lit("20000101"))
    delivery.put(".PART", table(spark, sf_dir, "part"), F.lit("20000101"))
    delivery.announce()
    delivery.load()
    return delivery.store.job_log().select("file_nm", "step_nm", "status", "row_cnt")


def rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run: nothing waits, and what was promised and loaded before is not missing."""
    return orders_by_year(spark, sf_dir).load().drop("job_run_id", "category")


def earlier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = monitor.earlier_load_summary(orders_by_year(spark, sf_dir).store.job_log())
    return summary.select("file_nm", "validation_status", "load_status", "rows_loaded", "view_status")


def history_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of a category folder after a run, archived ones among them."""
    delivery = orders_by_year(spark, sf_dir)
    listing = list_folder(spark, delivery.cfg.landing_root, delivery.cfg.folder(delivery.category))
    path = F.replace("relative_path", F.lit(delivery.category), F.lit("CATEGORY"))
    return listing.select(path.alias("relative_path"), (F.col("size") > 0).alias("has_content"))


def newest_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head of the load summary, newest first: a report of three rows."""
    summary = orders_by_year(spark, sf_dir).store.load_summary()
    newest = summary.orderBy(F.desc("start_ts"), F.desc("file_nm")).limit(3)
    return newest.select("file_nm", "load_status", "rows_loaded")


def log_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who logged each step, under which run, and when: the shape of what differs from run to run."""
    log = orders_by_year(spark, sf_dir).store.job_log()
    uuid_form = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    now = F.current_timestamp()
    return log.select(
        "file_nm",
        "step_nm",
        F.col("job_run_id").rlike(uuid_form).alias("is_uuid"),
        (F.col("created_by") == F.current_user()).alias("is_user"),
        ((F.col("start_ts") <= F.col("end_ts")) & (F.col("end_ts") <= now) & (F.col("start_ts") > now - F.expr("interval 1 day"))).alias("is_now"),
    )


def current_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the views of the catalog serve, after one of three was dropped."""
    delivery = Delivery(spark)
    for feed in ("region", "nation", "supplier"):
        delivery.put(feed.upper(), table(spark, sf_dir, feed), F.lit("20240101"))
    delivery.announce()
    delivery.load()
    spark.sql(f"DROP VIEW {delivery.category}_VW.NATION")
    found = delivery.store.current_view_source(delivery.category)
    served = F.replace("points_to", F.lit(delivery.category), F.lit("CATEGORY"))
    return found.select("view_name", served.alias("points_to"), F.col("last_refreshed").isNotNull().alias("has_time"))


def probed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and rows of the files in place, found by a pattern of their path."""
    found = probe_files(spark, rejected(spark, sf_dir).cfg.landing_root, "D[^/]*/ORDERS_[0-9]{8}[.]csv")
    return found.select(names.last_segment("file_path").alias("file_nm"), "actual_col_cnt", "actual_row_cnt")


def all_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every manifest below the landing zone."""
    cfg = rejected(spark, sf_dir).cfg
    rows = read_all_manifests(spark, cfg.landing_root, cfg.manifest_prefix)
    counts = [F.trim(c).cast("long").alias(c) for c in ("col_cnt", "row_cnt")]
    return rows.select("file_nm", *counts)


def manifest_driven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year, with the manifest as the driving side: it names each file three times, once with a wrong
    count, and one year more."""
    delivery = Delivery(spark)
    orders = table(spark, sf_dir, "orders")
    delivery.put("ORDERS", orders, F.date_format(F.trunc("o_orderdate", "year"), "yyyyMMdd"))
    exact = delivery.counts[0]
    later = late_years(orders).join(exact, "file_nm", "left_anti")
    wrong = exact.withColumn("row_cnt", F.col("row_cnt") + 1)
    delivery.announce(reduce(DataFrame.unionByName, [exact, exact, wrong, later]))
    delivery.load(driven_by="manifest")
    audit = delivery.store.audit_log()
    return audit.select("file_nm", "check_nm", "expected_val", "actual_val", "check_status")
