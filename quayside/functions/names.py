"""File, table and view names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A dated name ends in an underscore and eight digits; an unquoted
# table name starts with a letter or underscore.
DATE_SUFFIX = "_[0-9]{8}$"
DATED_NAME = "^.*_[0-9]{8}$"
LEGAL_TABLE_NAME = "^[A-Za-z_][A-Za-z0-9_]*$"


def file_key(name: Column | str) -> Column:
    """File names are matched without regard to case."""
    return F.upper(name)


def last_segment(path: Column | str) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(-1))


def table_name(file_nm: Column | str) -> Column:
    """The part of a file name before its first dot, but for dots at its beginning."""
    return F.split_part(F.ltrim(file_nm, F.lit(".")), F.lit("."), F.lit(1))


def table_part(file_nm: str) -> str:
    """``table_name`` for a plain text."""
    return file_nm.lstrip(".").split(".", 1)[0]


def base_name(table_nm: Column | str) -> Column:
    """A table name without its date: the name of the published view."""
    return F.regexp_replace(table_nm, DATE_SUFFIX, "")


def strip_date(table_nm: str) -> str:
    """``base_name`` for a plain text."""
    return re.sub(DATE_SUFFIX, "", table_nm)


def is_dated(table_nm: Column | str) -> Column:
    return F.rlike(table_nm, F.lit(DATED_NAME))


def scanned_uri() -> Column:
    """Path of the scanned row, URL-encoded as the scan reports it."""
    return F.col("_metadata.file_path")


def decoded(uri: Column | str) -> Column:
    """A scanned path as the file system spells it."""
    uri = F.col(uri) if isinstance(uri, str) else uri
    plain = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(uri, F.lit("%")), plain).otherwise(uri)
