"""Folder listings."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import names
from quayside.session import local_frame
from quayside.sources import hadoop

LISTING = "relative_path string, size long, last_modified timestamp, file_path string"


def list_folder(
    spark: SparkSession, root: str, below: str = "", skip: tuple[str, ...] = ()
) -> DataFrame:
    """One row per file, empty and hidden files included, as of now.

    Only file names, sizes and times pass the driver, as in the listing Spark makes
    itself before any scan.
    """
    base = hadoop.qualified(spark, root)
    rows = [
        (path, size, datetime.fromtimestamp(ms / 1000, timezone.utc), f"{base}/{path}")
        for path, size, ms in hadoop.walk(spark, root, below, skip)
    ]
    return local_frame(spark, rows, LISTING)


def waiting_files(
    listing: DataFrame, folder: str, archive_folder: str, manifest_prefix: str
) -> DataFrame:
    """Files of a folder that wait to be loaded: not archived, no manifest, no placeholder."""
    name = names.last_segment("relative_path")
    path = F.col("relative_path")
    return listing.where(
        path.startswith(folder)
        & ~path.startswith(archive_folder)
        & ~name.ilike(f"{manifest_prefix}%")
        & (name != "")
    ).withColumn("file_nm", name)
