"""Numbers, times and the kind of a text value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The literal forms a column type is inferred from. Whole numbers have up
# to 38 digits; dates are yyyy-MM-dd.
WHOLE = r"^[+-]?[0-9]{1,38}$"
DECIMAL = r"^[+-]?([0-9]+[.][0-9]*|[.][0-9]+)$"
SCIENTIFIC = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)[eE][+-]?[0-9]{1,3}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$"
MAX_WHOLE_DIGITS = 38
# A double keeps any number of 15 significant digits between these sizes.
DOUBLE_DIGITS = 15
SMALLEST_DOUBLE, LARGEST_DOUBLE = 2.2250738585072014e-308, 1.7976931348623157e308
DATE_LENGTH, TIMESTAMP_LENGTH = 10, 19

# One bit per kind, so that "all kinds seen in a column" is a bitwise or.
KIND_WHOLE = 1
KIND_DECIMAL = 2
KIND_SCIENTIFIC = 4
KIND_DATE = 8
KIND_TIMESTAMP = 16
KIND_TEXT = 32


def try_number(text: Column | str) -> Column:
    """Whole number from text, rounded half up; NULL if it is not a number."""
    return F.trim(text).try_cast("decimal(38,0)")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed from start to end."""
    return F.unix_seconds(F.date_trunc("SECOND", end).cast("timestamp")) - F.unix_seconds(
        F.date_trunc("SECOND", start).cast("timestamp")
    )


def _signed(value: Column) -> Column:
    """Of values that look like numbers: is there a sign in front?"""
    return value < "."


def kind(value: Column | str) -> Column:
    """Kind bit of a text value; NULL for NULL.

    This runs once per value of every file, so lengths and positions come first and a
    pattern is tried only where they leave the kind open. Casts that throw on bad input
    are kept away from it.
    """
    value = F.col(value) if isinstance(value, str) else value
    like_number = (value >= "+") & (value < ":")
    length, point = F.octet_length(value), F.instr(value, ".")
    unsigned_digits = (length <= MAX_WHOLE_DIGITS) & ~value.rlike("[^0-9]")
    like_date = (length == DATE_LENGTH) & (F.instr(value, "-") == 5)
    like_time = (length >= TIMESTAMP_LENGTH) & (F.instr(value, "-") == 5)
    return (
        F.when(value.isNull(), F.lit(None).cast("int"))
        .when(~like_number, KIND_TEXT)
        .when(like_date & (value.try_cast("date").cast("string") == value), KIND_DATE)
        .when(like_time & value.rlike(TIMESTAMP), _timestamp_or_text(value))
        .when((point > 0) & value.rlike(DECIMAL), KIND_DECIMAL)
        .when(~_signed(value) & unsigned_digits, KIND_WHOLE)
        .when(_signed(value) & value.rlike(WHOLE), KIND_WHOLE)
        .when(value.rlike(SCIENTIFIC), KIND_SCIENTIFIC)
        .otherwise(KIND_TEXT)
    )


def _timestamp_or_text(value: Column) -> Column:
    return F.when(value.try_cast("timestamp_ntz").isNotNull(), KIND_TIMESTAMP).otherwise(KIND_TEXT)


def whole_digits(value: Column | str) -> Column:
    """Digits before the decimal point of a number, sign not counted."""
    value = F.col(value) if isinstance(value, str) else value
    point = F.instr(value, ".")
    end = F.when(point > 0, point - 1).otherwise(F.octet_length(value))
    return end - F.when(_signed(value), 1).otherwise(0)


def keeps_as_double(value: Column | str) -> Column:
    """Does a number keep its value as a double: at most 15 significant digits, no over- or underflow?"""
    value = F.col(value) if isinstance(value, str) else value
    exponent = F.greatest(F.instr(value, "e"), F.instr(value, "E"))
    digits = F.when(exponent > 0, F.substring(value, F.lit(1), exponent - 1)).otherwise(value)
    significant = F.regexp_replace(F.regexp_replace(digits, "[+.-]", ""), "^0+|0+$", "")
    size = F.abs(value.try_cast("double"))
    in_range = size.between(SMALLEST_DOUBLE, LARGEST_DOUBLE) | (significant == "")
    short = (F.octet_length(value) <= DOUBLE_DIGITS) & (exponent == 0)
    # not an OR: its sides would be evaluated for every value, also where the cheap one decides
    return F.when(short, F.lit(True)).otherwise((F.length(significant) <= DOUBLE_DIGITS) & F.coalesce(in_range, F.lit(False)))


def scale_digits(value: Column | str) -> Column:
    """Digits after the decimal point of a number that has one."""
    return F.octet_length(value) - F.instr(value, ".")
