"""Expressions over the physical lines of a CSV file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delimiter and quote of the file format.
DELIMITER = ","
QUOTE = '"'
ESCAPED_QUOTE = '""'

# A field that opens and closes on this line, with whatever follows it up to the
# delimiter, and a field that opens only. Doubled quotes are taken out beforehand,
# so plain character classes are enough and nothing recurses on long fields.
_CLOSED_FIELD = r'(^|,)\s*"[^"]*+"[^,]*+'
_OPENING = r'(^|,)\s*"'
_REST_OF_OPEN_FIELD = r'^[^"]*+"[^,]*+'
_PRINTING = r"[^\x00-\x20]"


def column_count(line: Column | str) -> Column:
    """Comma-separated parts of a line; quotes are not looked at."""
    return F.size(F.split(line, DELIMITER))


def is_blank(line: Column | str) -> Column:
    """True for the lines the CSV reader skips: nothing but spaces and control characters."""
    return ~F.rlike(line, F.lit(_PRINTING))


def has_quote(line: Column | str) -> Column:
    return F.contains(F.col(line) if isinstance(line, str) else line, F.lit(QUOTE))


def _opens(bare: Column) -> Column:
    return F.regexp_replace(bare, _CLOSED_FIELD, "$1").rlike(_OPENING)


def open_after(line: Column | str) -> Column:
    """Does a quoted field run past the end of this line, if none is open at its start?"""
    bare = F.replace(line, F.lit(ESCAPED_QUOTE), F.lit(""))
    return F.when(has_quote(line), _opens(bare)).otherwise(F.lit(False))


def still_open_after(line: Column | str) -> Column:
    """The same, if a quoted field is already open at the start of the line."""
    bare = F.replace(line, F.lit(ESCAPED_QUOTE), F.lit(""))
    return F.when(~has_quote(bare), F.lit(True)).otherwise(
        _opens(F.regexp_replace(bare, _REST_OF_OPEN_FIELD, ""))
    )
