"""Scalar column functions.

Sessions run in ANSI mode, where a bad cast raises. Input here comes from raw records, so every
conversion is the ``try_`` form: what cannot be read becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long"}

# What Spark reads as a number or a flag. An integer type takes the whole part.
_WHOLE = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"
_FRACTION = r"^\s*[+-]?\.\d+\s*$"
_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
_FLAG = r"(?i)^\s*(?:t|true|y|yes|1|f|false|n|no|0)\s*$"


def lenient_cast(text: Column, to: str) -> Column:
    """Text to a type, or NULL where it cannot be read.

    A decimal text such as ``"12.5"`` or ``".5"`` read as an integer type keeps its whole part. Numbers and flags are
    matched by a pattern first: a failing ``try_cast`` of those costs an exception per row, which on dirty
    columns takes many times longer than the rest of the query.
    """
    if to == "timestamp":
        return parse_timestamp(text)
    if to in _INTEGRAL:
        whole = F.nullif(F.regexp_extract(text, _WHOLE, 1), F.lit("")).try_cast(to)
        return F.when(F.rlike(text, F.lit(_FRACTION)), F.lit(0).cast(to)).otherwise(whole)
    if to == "boolean":
        return F.when(F.rlike(text, F.lit(_FLAG)), text).try_cast(to)
    if to in ("float", "double") or to.startswith("decimal"):
        return F.when(F.rlike(text, F.lit(_NUMBER)), text).try_cast(to)
    return text.try_cast(to)


def parse_timestamp(column: Column) -> Column:
    """ISO-8601 text (or a date or timestamp) to a timestamp; NULL where it cannot be read."""
    return F.try_to_timestamp(column)


def null_of(to: str) -> Column:
    """A typed NULL."""
    return F.lit(None).cast(to)


def first_element(column: Column) -> Column:
    """Element 0 of an array; NULL for an empty or NULL array."""
    return F.get(column, F.lit(0))


def first_or_default(column: Column, field: str, default: str = "") -> Column:
    """``field`` of the first element, or ``default`` where there is none."""
    return F.coalesce(first_element(column)[field], F.lit(default))


def first_truthy(*columns: Column) -> Column:
    """The first column that is neither NULL nor empty; the last one is taken as it is."""
    *head, last = columns
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in head], last)


def bool_text(column: Column) -> Column:
    """A flag as the text ``True``, ``False`` or ``None``."""
    return F.when(column.isNull(), "None").when(column, "True").otherwise("False")


def full_name(given: Column, family: Column) -> Column:
    """Both names joined by a space; the empty text when both are NULL."""
    return F.trim(F.concat_ws(" ", given, family))


def ratio(numerator: Column, denominator: Column, otherwise: Column | None = None) -> Column:
    """Division as a double that gives ``otherwise`` (NULL by default) for a zero or NULL result."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if otherwise is None else F.coalesce(quotient, otherwise)


def major_units(column: Column) -> Column:
    """Money in minor units (cents) to major units."""
    return ratio(column, F.lit(100))


def trailing_number(column: Column) -> Column:
    """The digits at the end of a text as an int; NULL where it ends in none."""
    return F.nullif(F.regexp_extract(column, r"(\d+)$", 1), F.lit("")).try_cast("int")


def reporting_date(business_id: Column, start: str, days: int) -> Column:
    """Spread business ids over ``days`` dates from ``start`` by their trailing number."""
    offset = F.pmod(trailing_number(business_id) - 1, F.lit(days))
    return F.date_add(F.lit(start).cast("date"), offset)


def distinct_with_null(column: Column, where: Column | None = None) -> Column:
    """Aggregate: number of distinct values with NULL counted as a value; NULL over no rows.

    ``where`` limits the rows counted.
    """
    kept = F.lit(True) if where is None else where
    values = F.count_distinct(column if where is None else F.when(where, column))
    blank = F.max(F.when(kept & column.isNull(), 1).otherwise(0)).cast("long")
    return F.when(F.count_if(kept) > 0, values + blank)
