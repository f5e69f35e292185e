"""Manifests: what a vendor says was delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import names, values
from quayside.session import local_frame
from quayside.sources import hadoop
from quayside.sources.files import CSV_FORMAT

RAW_MANIFEST = "file_nm string, col_cnt string, row_cnt string, file_date string, owner string"


def parse_manifest(raw: DataFrame) -> DataFrame:
    """Trim names, turn counts into whole numbers or NULL, drop rows without a name."""
    name = F.trim("file_nm")
    return (
        raw.where(F.nullif(name, F.lit("")).isNotNull())
        .withColumn("file_nm", name)
        .withColumn("col_cnt", values.try_number("col_cnt"))
        .withColumn("row_cnt", values.try_number("row_cnt"))
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One manifest by position; a manifest that is not there lists nothing."""
    if not hadoop.exists(spark, path):
        return parse_manifest(local_frame(spark, [], RAW_MANIFEST))
    raw = spark.read.schema(RAW_MANIFEST).options(header="true", **CSV_FORMAT)
    return parse_manifest(raw.csv(hadoop.glob_safe(path)))


def read_all_manifests(spark: SparkSession, root: str, manifest_prefix: str) -> DataFrame:
    """Every manifest below a root, with the file each row comes from."""
    raw = (
        spark.read.schema(RAW_MANIFEST)
        .options(header="true", recursiveFileLookup="true", **CSV_FORMAT)
        .csv(root)
        .where(names.scanned_uri().rlike(f"^.*{manifest_prefix}_.*[.]csv$"))
    )
    return raw.select(names.decoded(names.scanned_uri()).alias("inventory_file"), "*")
