import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayside.functions import names, text, values


def one(spark, value, column, type_="string"):
    return spark.createDataFrame([(value,)], f"x {type_}").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    ("file_nm", "table", "base"),
    [
        ("HDS_FACILITY_20260914.csv", "HDS_FACILITY_20260914", "HDS_FACILITY"),
        ("A.B_20260914.csv", "A", "A"),
        ("X_20260914_V2.csv", "X_20260914_V2", "X_20260914_V2"),
        ("X_202609140.csv", "X_202609140", "X_202609140"),
    ],
)
def test_table_and_base_names(spark, file_nm, table, base):
    assert one(spark, file_nm, names.table_name("x")) == table
    assert one(spark, file_nm, names.base_name(names.table_name("x"))) == base
    assert names.strip_date(table) == base


def test_dated_names_match_as_a_whole(spark):
    assert one(spark, "HDS_FACILITY_20260914", names.is_dated("x"))
    assert not one(spark, "HDS_FACILITY_202609140", names.is_dated("x"))


def test_last_segment_of_a_folder_is_empty(spark):
    assert one(spark, "HDS/", names.last_segment("x")) == ""
    assert one(spark, "HDS/a/b.csv", names.last_segment("x")) == "b.csv"


@pytest.mark.parametrize(
    ("written", "number"),
    [(" 20 ", 20), ("19.6", 20), ("12.5", 13), ("", None), ("n/a", None), ("1,000", None), (None, None)],
)
def test_try_number(spark, written, number):
    found = one(spark, written, values.try_number("x"))
    assert found == (None if number is None else Decimal(number))


def test_seconds_count_boundaries(spark):
    row = spark.sql(
        "select timestamp'2024-01-01 00:00:00.9' a, timestamp'2024-01-01 00:00:01.1' b"
    ).select(values.seconds_between("a", "b").alias("s"))
    assert row.first().s == 1


@pytest.mark.parametrize(
    ("value", "kind"),
    [
        ("12", values.KIND_WHOLE),
        ("-12", values.KIND_WHOLE),
        ("+007", values.KIND_WHOLE),
        ("9" * 38, values.KIND_WHOLE),
        ("9" * 39, values.KIND_TEXT),
        ("-" + "9" * 38, values.KIND_WHOLE),
        ("1.50", values.KIND_DECIMAL),
        ("-.5", values.KIND_DECIMAL),
        ("1.", values.KIND_DECIMAL),
        (".", values.KIND_TEXT),
        ("1.2.3", values.KIND_TEXT),
        ("1e5", values.KIND_SCIENTIFIC),
        ("-1.5E-10", values.KIND_SCIENTIFIC),
        ("2024-02-29", values.KIND_DATE),
        ("2023-02-29", values.KIND_TEXT),
        ("2024-2-9", values.KIND_TEXT),
        ("9999-12-31", values.KIND_DATE),
        ("2024-01-1T", values.KIND_TEXT),
        ("2024-01-01 10:00:00", values.KIND_TIMESTAMP),
        ("2024-01-01T10:00:00.123456", values.KIND_TIMESTAMP),
        ("2024-01-01 25:00:00", values.KIND_TEXT),
        ("12-3", values.KIND_TEXT),
        ("--1", values.KIND_TEXT),
        (",5", values.KIND_TEXT),
        ("/5", values.KIND_TEXT),
        ("Y", values.KIND_TEXT),
        ("", values.KIND_TEXT),
        ("12\n", values.KIND_TEXT),
        ("٣", values.KIND_TEXT),
        (None, None),
    ],
)
def test_kind_of_a_value(spark, value, kind):
    assert one(spark, value, values.kind("x")) == kind


@pytest.mark.parametrize(
    ("value", "whole", "scale"), [("12", 2, None), ("-12", 2, None), ("1.50", 1, 2), ("-.5", 0, 1), ("+10.", 2, 0)]
)
def test_digits(spark, value, whole, scale):
    assert one(spark, value, values.whole_digits("x")) == whole
    if scale is not None:
        assert one(spark, value, values.scale_digits("x")) == scale


def ends_open(line, state):
    """Character by character: is a quoted field open after the line?"""
    i, at_field_start = 0, not state
    while i < len(line):
        c = line[i]
        if state:
            if c == '"' and line[i + 1 : i + 2] == '"':
                i += 1
            elif c == '"':
                state = False
        elif c == '"' and at_field_start:
            state = True
        at_field_start = not state and (c == "," or (at_field_start and c in " \t"))
        i += 1
    return state


def test_quote_state_against_a_scanner(spark):
    rng = random.Random(7)
    fields = ["", "a", "7", '""', '"a"', '"a,b"', '"say ""hi"""', 'in"ch', ' "pad"', '"""q"""']
    lines = set()
    for _ in range(1500):
        line = ",".join(rng.choice(fields) for _ in range(rng.randint(1, 4)))
        cut = rng.randint(0, len(line))
        lines |= {line, line + ',"open', line + ',"a ""b"" c', line[cut:] if '""' not in line else line}
    lines |= {'"', '""', '"""', 'x"', '",', ',"', '"a","', 'end of field",next,"open again'}
    frame = spark.createDataFrame([(line,) for line in sorted(lines)], "line string")
    found = frame.select(
        "line", text.open_after("line").alias("c"), text.still_open_after("line").alias("o")
    ).collect()
    wrong = [r.line for r in found if r.c != ends_open(r.line, False) or r.o != ends_open(r.line, True)]
    assert wrong == []


def test_blank_lines_and_column_counts(spark):
    assert one(spark, " \t\r", text.is_blank("x"))
    assert not one(spark, " a", text.is_blank("x"))
    assert one(spark, "a,b,", text.column_count("x")) == 3
    assert one(spark, 'a,"b,c"', text.column_count("x")) == 3


def test_scanned_names_are_decoded(spark):
    assert one(spark, "file:/x/a%20b%25+c.csv", names.decoded("x")) == "file:/x/a b%+c.csv"


def test_long_quoted_field_does_not_recurse(spark):
    line = '"' + 'x""' * 200_000 + '",1'
    frame = spark.createDataFrame([(line,)], "line string")
    assert frame.select(text.open_after("line").alias("o")).first().o is False
    assert frame.select(F.length("line").alias("n")).first().n == len(line)
