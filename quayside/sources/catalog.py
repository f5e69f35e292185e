"""Catalog scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.session import local_frame

CATALOG = "table_schema string, table_nm string, table_type string, comment string"
VIEW_TYPES = ("VIEW", "TEMPORARY")


def entries(spark: SparkSession, database: str) -> list:
    """Tables and views of a database; views of the session itself are left out."""
    if not spark.catalog.databaseExists(database):
        return []
    return [t for t in spark.catalog.listTables(database) if not t.isTemporary]


def list_catalog(spark: SparkSession, database: str) -> DataFrame:
    """Tables and views of a database; nothing if there is no such database."""
    rows = [
        (database, t.name.upper(), t.tableType, t.description) for t in entries(spark, database)
    ]
    return local_frame(spark, rows, CATALOG)


def base_tables(catalog: DataFrame) -> DataFrame:
    return catalog.where(~catalog.table_type.isin(*VIEW_TYPES))


def views(catalog: DataFrame) -> DataFrame:
    return catalog.where(catalog.table_type == "VIEW")
