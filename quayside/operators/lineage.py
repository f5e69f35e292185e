"""Lineage columns of loaded rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from quayside import vocabulary as v


def lineage_clash(columns: Sequence[str]) -> list[str]:
    """Columns of a file that have the name of a lineage column."""
    return sorted({name.upper() for name in columns} & {v.SRC_FILE_NM, v.LOAD_TS})


def with_lineage(rows: DataFrame, source: Column, loaded_at: Column) -> DataFrame:
    """Adds where each row came from and when it was loaded."""
    clash = lineage_clash(rows.columns)
    if clash:
        raise ValueError(f"the file has its own column {', '.join(clash)}")
    return rows.withColumns({v.SRC_FILE_NM: source, v.LOAD_TS: loaded_at})
