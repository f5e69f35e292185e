"""Column types of CSV data, from every value of every file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import values as val

# Whole numbers up to 9 and 18 digits fit an int and a bigint, and a
# decimal holds 38 digits.
INT_DIGITS, LONG_DIGITS, MAX_DIGITS = 9, 18, 38


def column_values(rows: DataFrame, width: int) -> DataFrame:
    """One row per value: ``file_uri, pos, value`` and whether its record has a wrong width."""
    columns = F.array(*(F.col(f"c{i}") for i in range(width)))
    return rows.select(
        "file_uri",
        F.col("_corrupt_record").isNotNull().alias("bad_width"),
        F.posexplode(columns).alias("pos", "value"),
    )


def profile_values(column_values: DataFrame, *keys: str) -> DataFrame:
    """Per key: the kinds of value seen, their digits, and records of a wrong width.

    Fixed-width buffers only, so each task reduces its values to one row per column.
    """
    tagged = column_values.withColumn("kind", val.kind("value"))
    whole = F.col("kind").isin(val.KIND_WHOLE, val.KIND_DECIMAL)
    number = whole | (F.col("kind") == val.KIND_SCIENTIFIC)
    return tagged.groupBy(*keys).agg(
        F.coalesce(F.bit_or("kind"), F.lit(0)).alias("kinds"),
        F.coalesce(F.max(F.when(whole, val.whole_digits("value"))), F.lit(0)).alias("whole_digits"),
        F.coalesce(
            F.max(F.when(F.col("kind") == val.KIND_DECIMAL, val.scale_digits("value"))), F.lit(0)
        ).alias("scale"),
        F.count_if(F.when(number, ~val.keeps_as_double("value"))).alias("not_doubles"),
        F.count_if("bad_width").alias("bad_records"),
    )


def column_type() -> Column:
    """Spark type of a profiled column that keeps every value; a column without values is text.

    Numbers of more digits than a decimal holds, and columns with scientific notation of which a value
    would change as a double, stay text.
    """
    kinds = F.col("kinds")
    digits, scale = F.col("whole_digits"), F.col("scale")

    def only(allowed: int) -> Column:
        return (kinds > 0) & (kinds.bitwiseAND(F.lit(~allowed & 63)) == 0)

    precision = F.greatest(digits + scale, F.lit(1))
    numbers = val.KIND_WHOLE | val.KIND_DECIMAL
    times = val.KIND_DATE | val.KIND_TIMESTAMP
    return (
        F.when(only(val.KIND_WHOLE) & (digits <= INT_DIGITS), "int")
        .when(only(val.KIND_WHOLE) & (digits <= LONG_DIGITS), "bigint")
        .when(only(val.KIND_WHOLE), f"decimal({MAX_DIGITS},0)")
        .when(
            only(numbers) & (precision <= MAX_DIGITS),
            F.concat(F.lit("decimal("), precision, F.lit(","), scale, F.lit(")")),
        )
        .when(
            only(numbers | val.KIND_SCIENTIFIC)
            & (kinds.bitwiseAND(F.lit(val.KIND_SCIENTIFIC)) > 0)
            & (F.col("not_doubles") == 0),
            "double",
        )
        .when(only(val.KIND_DATE), "date")
        .when(only(times), "timestamp_ntz")
        .otherwise("string")
    )


def in_file_order(pos: str, value: Column) -> Column:
    """The values of all columns as an array in file order; an aggregate."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(pos).alias("at"), value.alias("value"))))
    return F.transform(ordered, lambda c: c["value"])


def schema_template(profiled: DataFrame, name: str, pos: str) -> DataFrame:
    """All columns with their types as one text, in file order."""
    columns = in_file_order(pos, F.concat(F.col(name), F.lit(" "), F.col("column_type")))
    return profiled.agg(F.array_join(columns, ", ").alias("ddl"))
