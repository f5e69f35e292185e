"""Dated tables in the catalog, the views over the newest, and the archive."""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.config import IntakeConfig
from quayside.functions import names
from quayside.operators.latest import latest_tables, rows_of_latest
from quayside.plans.logstore import bucket_of_text
from quayside.plans.oplog import TABLE_SCHEMA, VIEW_SCHEMA, OpsStore, utc_now
from quayside.session import local_frame
from quayside.sources import hadoop


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ensure_databases(spark: SparkSession, category: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(category)}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(category + '_VW')}")


class Publisher:
    """Registers the tables and views of one category and remembers them in the store."""

    def __init__(self, spark: SparkSession, cfg: IntakeConfig, store: OpsStore, category: str):
        self.spark, self.cfg, self.store, self.category = spark, cfg, store, category
        self.view_schema = f"{category}_VW"
        self._known: dict[str, Row] = {}
        self._newest: dict[str, Row] = {}
        self._tables: list[tuple] = []
        self._views: list[tuple] = []

    def _registered(self, bases: Iterable[str]) -> DataFrame:
        """Registrations of this category, at least those of some base names."""
        known = self.store.read("table_registry", map(bucket_of_text, bases))
        return known.where(F.col("table_schema") == self.category)

    def _lookup(self, table_names: Iterable[str]) -> dict[str, Row]:
        """The newest registration of each of some tables."""
        wanted_names = set(table_names)
        if not wanted_names:
            return {}
        wanted = local_frame(self.spark, [(n,) for n in wanted_names], "table_nm string")
        newest = F.max_by(F.struct("location", "schema_json"), "registered_at").alias("t")
        known = self._registered(map(names.strip_date, wanted_names)).join(wanted, "table_nm", "left_semi")
        return {row.table_nm: row.t for row in known.groupBy("table_nm").agg(newest).collect()}

    def _has(self, database: str, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{_quoted(database)}.{_quoted(name)}")

    def rehydrate(self) -> None:
        """Bring back the published views that the catalog of this session does not have.

        Work goes with the number of views, not of the tables ever loaded: of these only the ones
        that a missing view serves are registered.
        """
        ensure_databases(self.spark, self.category)
        published = self.store.published_views(self.category).collect()
        missing = {
            r.view_name: r.points_to for r in published if not self._has(self.view_schema, r.view_name)
        }
        if missing:
            self._restore(target.rsplit(".", 1)[1] for target in missing.values())
            for view_name, points_to in missing.items():
                self._create_view(view_name, points_to)

    def _restore(self, table_names: Iterable[str]) -> None:
        self._bring_back(self._lookup(table_names))

    def _bring_back(self, registrations: dict[str, Row]) -> None:
        for table_nm, known in registrations.items():
            if not self._has(self.category, table_nm):
                schema = T.StructType.fromJson(json.loads(known.schema_json))
                self._create_table(table_nm, known.location, schema)

    def prepare(self, table_names: Iterable[str]) -> None:
        """Look up earlier loads of the tables that this run is about to write."""
        self._known = self._lookup(n.upper() for n in table_names)

    def _create_table(self, table_nm: str, location: str, schema: T.StructType) -> None:
        self.spark.catalog.createTable(
            f"{_quoted(self.category)}.{_quoted(table_nm)}",
            path=location,
            source="parquet",
            schema=schema,
        )

    def _create_view(self, view_name: str, points_to: str) -> None:
        target = points_to.rsplit(".", 1)[1]
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {_quoted(self.view_schema)}.{_quoted(view_name)} "
            f"COMMENT '{points_to}' "
            f"AS SELECT * FROM {_quoted(self.category)}.{_quoted(target)}"
        )

    def put_table(self, table_nm: str, location: str, schema: T.StructType) -> None:
        """Make a freshly written folder the dated table, replacing an earlier load of it."""
        name = table_nm.upper()
        self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(self.category)}.{_quoted(name)}")
        self._create_table(name, location, schema)
        self._tables.append((self.category, name, location, json.dumps(schema.jsonValue()), utc_now()))

    def put_view(self, view_name: str, latest_table: str) -> None:
        points_to = self.cfg.table_label(self.category, latest_table)
        if not self._has(self.category, latest_table):
            self._bring_back({latest_table: self._newest[latest_table]})
        self._create_view(view_name, points_to)
        self._views.append((self.view_schema, view_name.upper(), points_to, utc_now()))

    def latest(self, bases: Iterable[str]) -> dict[str, str]:
        """Newest dated table of each of some base names: one job over the registry."""
        wanted_bases = set(bases)
        wanted = local_frame(self.spark, [(b,) for b in wanted_bases], "base_nm string")
        tables = self._registered(wanted_bases).withColumn("base_nm", names.base_name("table_nm"))
        tables = tables.join(wanted, "base_nm", "left_semi")
        newest = rows_of_latest(tables.withColumn("name", F.col("table_nm")), latest_tables(tables.select("table_nm")))
        known = F.max_by(F.struct("location", "schema_json"), "registered_at").alias("t")
        found = newest.groupBy("base_nm", "name").agg(known).collect()
        self._newest = {row.name: row.t for row in found}
        return {row.base_nm: row.name for row in found}

    def remember(self) -> None:
        """Write this run's tables and views to the registries, then drop replaced data."""
        new = [
            ("table_registry", self._tables, TABLE_SCHEMA),
            ("view_registry", self._views, VIEW_SCHEMA),
        ]
        with ThreadPoolExecutor(2) as pool:
            done = [
                pool.submit(
                    self.store.append, name, local_frame(self.spark, rows, schema).coalesce(1)
                )
                for name, rows, schema in new
                if rows
            ]
        for write in done:
            write.result()
        current = {row[1]: row[2] for row in self._tables}
        replaced = [row[2] for row in self._tables if row[2] != current[row[1]]]
        replaced += [self._known[name].location for name in current if name in self._known]
        for location in set(replaced) - set(current.values()):  # a run that is finished again finds its own
            if location.startswith(f"{self.cfg.store_root}/tables/"):
                hadoop.delete(self.spark, location)
        self._tables, self._views = [], []


def archive_file(
    spark: SparkSession, cfg: IntakeConfig, category: str, file_nm: str, loaded: datetime | None = None
) -> datetime:
    """Move a loaded file to the history folder of its category.

    With ``loaded``, when a run that died had loaded it, the file may be there already, and one of its name that came
    after that is another delivery and stays.
    """
    source = f"{cfg.landing_root}/{cfg.folder(category)}{file_nm}"
    target = f"{cfg.landing_root}/{cfg.history(category)}{file_nm}"
    there = loaded is not None and hadoop.exists(spark, target)
    if not there or hadoop.exists(spark, source) and hadoop.modified(spark, source) <= loaded:
        hadoop.move(spark, source, target)
    return utc_now()
