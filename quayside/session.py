"""Session helpers: a local session for tests and benches, and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores: int | str = "*", app: str = "quayside", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="quayside-wh-"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session like the given one, with settings of its own; it shares context, catalog and storage."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key, value in settings.items():
        own.conf.set(key, value)
    return own


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = _own_folder()
    return named.rstrip("/")


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="quayside-")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, *partition_by: str) -> DataFrame:
    """Write a frame below a shared folder and read it back.

    The result survives the loss of executors, does not change when files are moved
    later, costs one evaluation, and has a size that joins can plan with.
    """
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_ARROW = {
    "string": pa.string(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "boolean": pa.bool_(),
    "timestamp": pa.timestamp("us", "UTC"),
}


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A frame of a few driver rows, without starting Python workers for it."""
    fields = T.StructType.fromDDL(schema).fields
    columns = zip(*rows) if rows else ([] for _ in fields)
    arrays = [
        pa.array(list(values), _ARROW[f.dataType.simpleString()])
        for f, values in zip(fields, columns)
    ]
    table = pa.Table.from_arrays(arrays, names=[f.name for f in fields])
    return spark.createDataFrame(table, schema)
