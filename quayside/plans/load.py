"""Loading files into dated tables."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from re import match
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.config import IntakeConfig
from quayside.functions import names, text
from quayside.operators.lineage import lineage_clash, with_lineage
from quayside.operators.profile import column_type, column_values, in_file_order, profile_values
from quayside.plans.faults import BadFile, blames_file
from quayside.plans.oplog import utc_now
from quayside.session import session_with
from quayside.sources import hadoop, quoted
from quayside.sources.files import read_lines, read_records, text_schema


# A task of a write keeps a file open for each table it meets, rather than sort its rows by table first.
WRITE_SETTINGS = {
    "spark.sql.optimizer.plannedWrite.enabled": "false",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


@dataclass
class FileLoad:
    """A file that passed its checks, and what became of it."""

    file_nm: str
    file_path: str
    size: int
    header_key: int | None
    header_open: bool
    broken_lines: bool
    unclosed: bool
    exp_rows: int | None
    row_nos: list[int] = field(default_factory=lambda: [0])  # of the manifest rows that promise it
    columns: list[str] = field(default_factory=list)
    types: list[str] = field(default_factory=list)
    location: str | None = None
    schema: T.StructType | None = None
    rows_loaded: int | None = None
    error: str | None = None
    started: datetime | None = None
    ended: datetime | None = None

    @property
    def table_nm(self) -> str:
        return names.table_part(self.file_nm)

    def fail(self, error: object) -> None:
        self.error, self.ended = str(error), utc_now()


class Loader:
    """Reads headers, infers types and writes tables for the files of one run.

    Files with one header are profiled by one job, and files with one header and the
    same types are written by one job, whatever their sizes: splits make its tasks.
    """

    def __init__(
        self,
        spark: SparkSession,
        cfg: IntakeConfig,
        category: str,
        run_id: str,
        records: quoted.QuotedRecords | None,
    ):
        self.spark, self.cfg, self.category, self.run_id = spark, cfg, category, run_id
        self.records = records
        self.loaded_at = utc_now()
        self.writer = session_with(spark, WRITE_SETTINGS)

    def load(self, files: list[FileLoad]) -> None:
        """Load all files; each one ends with ``rows_loaded`` or ``error`` set."""
        for f in files:
            f.started = utc_now()
            if not match(names.LEGAL_TABLE_NAME, f.table_nm):
                f.fail(f"{f.table_nm!r} is not a legal table name")
            elif f.header_key is None:
                f.fail(f"{f.file_nm} has no header to build a table from")
            elif f.unclosed:
                f.fail(f"{f.file_nm} ends inside a quoted field")
        with ThreadPoolExecutor(self.cfg.max_parallel_loads) as pool:
            self._each(pool, _alive(files), self._header_group, self._read_header)
            self._each(pool, _alive(files), self._header_group, self._profile)
            for wave in waves(_alive(files)):
                self._each(pool, wave, self._batch, self._write)

    def _each(
        self,
        pool: ThreadPoolExecutor,
        files: list[FileLoad],
        key: Callable[[FileLoad], object],
        work: Callable[[list[FileLoad]], None],
    ) -> None:
        """Run a job per group; a group that fails is halved until the bad files stand alone."""

        def guarded(group: list[FileLoad]) -> None:
            try:
                work(group)
            except Exception as error:
                if not blames_file(self.spark, error):
                    raise
                if len(group) == 1:
                    group[0].fail(error)
                    return
                half = len(group) // 2
                guarded(group[:half])
                guarded(group[half:])

        groups = defaultdict(list)
        for f in files:
            groups[key(f)].append(f)
        list(pool.map(guarded, groups.values()))

    def _header_group(self, f: FileLoad) -> object:
        return f.file_path if f.header_open else (f.header_key, f.broken_lines)

    def _batch(self, f: FileLoad) -> object:
        return self._header_group(f), tuple(f.types)

    def _records_of(self, group: list[FileLoad]) -> DataFrame:
        return quoted.record_texts(self.records.of([f.file_path for f in group]))

    def _read_header(self, group: list[FileLoad]) -> None:
        first = group[0]
        if first.broken_lines:
            header = self._records_of([first]).where("record_no = 1").first()["record"]
        else:
            top = read_lines(self.spark, [first.file_path]).where("block_start = 0")
            header = top.where(~text.is_blank("line")).first()["line"]
        try:
            columns = [c.strip() for c in next(csv.reader([header], skipinitialspace=True))]
        except csv.Error as error:
            raise BadFile(f"header cannot be read: {error}") from error
        folded = [c.upper() for c in columns]
        if "" in folded or len(set(folded)) < len(folded):
            raise BadFile(f"header has blank or repeated column names: {header[:200]}")
        if lineage_clash(columns):
            raise BadFile(f"the file has its own column {', '.join(lineage_clash(columns))}")
        for f in group:
            f.columns = columns

    def _profile(self, group: list[FileLoad]) -> None:
        width = len(group[0].columns)
        if group[0].broken_lines:
            rows = quoted.parse_records(self._records_of(group), ["string"] * width, "PERMISSIVE")
        else:
            rows = read_records(
                self.spark, [f.file_path for f in group], text_schema(width), mode="PERMISSIVE"
            )
        profiled = profile_values(column_values(rows, width), "file_uri", "pos")
        per_file = profiled.groupBy("file_uri").agg(
            in_file_order("pos", column_type()).alias("types"),
            F.max("bad_records").alias("bad_records"),
        )
        found = {
            row.file_path: row
            for row in per_file.withColumn("file_path", names.decoded("file_uri")).collect()
        }
        for f in group:
            profile = found.get(f.file_path)
            if profile is not None and profile.bad_records:
                f.fail(f"{profile.bad_records} record(s) do not have {width} columns")
                continue
            types = profile.types if profile is not None else ["string"] * width
            f.types = [
                "string" if name.upper() in self.cfg.text_columns else type_
                for name, type_ in zip(f.columns, types)
            ]

    def _write(self, group: list[FileLoad]) -> None:
        columns, types = group[0].columns, group[0].types
        uri, by_table = _free(columns, "file_uri"), _free(columns, "table_nm")
        typed = T.StructType.fromDDL(", ".join(f"c{i} {t}" for i, t in enumerate(types)))
        schema = T.StructType(
            [T.StructField(name, c.dataType) for name, c in zip(columns, typed.fields)]
        )
        if group[0].broken_lines:
            rows = quoted.parse_records(self._records_of(group), types, "FAILFAST")
        else:
            rows = read_records(
                self.writer,
                [f.file_path for f in group],
                schema,
                mode="FAILFAST",
                enforceSchema="false",
            )
        data = rows.toDF(*columns, uri)
        file_nm = names.last_segment(names.decoded(F.col(uri)))
        folder = f"{self.cfg.store_root}/tables/{self.category}/{self.run_id}/{uuid4().hex}"
        whole = with_lineage(
            data.withColumn(by_table, names.table_name(file_nm)),
            F.concat(F.lit(self.cfg.folder(self.category)), file_nm),
            F.lit(self.loaded_at).cast("timestamp"),
        ).drop(uri)
        if len(group) == 1:
            target = f"{folder}/{by_table}={group[0].table_nm}"
            whole.drop(by_table).write.mode("overwrite").parquet(target)
        else:
            whole.write.mode("overwrite").partitionBy(by_table).parquet(folder)

        stored = whole.drop(by_table).schema
        with_table = T.StructType([*stored.fields, T.StructField(by_table, T.StringType())])
        # no column is read for this: the row counts stand in the file footers
        counted = self.spark.read.schema(with_table).parquet(folder).groupBy(by_table).count()
        loaded = {row[0]: row[1] for row in counted.collect()}
        for f in group:
            f.rows_loaded = loaded.get(f.table_nm, 0)
            f.location = f"{folder}/{by_table}={f.table_nm}"
            if f.rows_loaded == 0:
                hadoop.make_folder(self.spark, f.location)
            f.schema = stored
            f.ended = utc_now()


def waves(files: list[FileLoad]) -> list[list[FileLoad]]:
    """Files in name order, those of one table name in different waves."""
    seen, found = defaultdict(int), defaultdict(list)
    for f in sorted(files, key=lambda f: f.file_nm):
        found[seen[f.table_nm.upper()]].append(f)
        seen[f.table_nm.upper()] += 1
    return list(found.values())


def _alive(files: list[FileLoad]) -> list[FileLoad]:
    return [f for f in files if f.error is None]


def _free(columns: list[str], wanted: str) -> str:
    """A helper column name that no column of the file has."""
    taken = {c.lower() for c in columns}
    while wanted in taken:
        wanted += "_"
    return wanted
