"""Date spines, the date dimension and padded calendars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starledger.functions.scalars import reporting_date
from starledger.operators.keys import first_per_key

# The reporting window business orders are spread over.
REPORTING_START = "2026-07-01"
REPORTING_DAYS = 50


def order_date_mapping(orders: DataFrame, start: str = REPORTING_START, days: int = REPORTING_DAYS) -> DataFrame:
    """One reporting date per business order id.

    Where several orders share a business id the smallest order id stands for it. Ids that end in no digit
    have no date.
    """
    one_each = first_per_key(orders.select("business_order_id", "order_id"), ["business_order_id"], ["order_id"])
    return one_each.withColumn("reporting_date", reporting_date(F.col("business_order_id"), start, days))


def date_bounds(*dates: DataFrame) -> DataFrame:
    """Smallest and largest date of several one-column frames, as one row. NULL dates do not count."""
    named = [d.select(F.col(d.columns[0]).cast("date").alias("date")) for d in dates]
    return reduce(DataFrame.unionAll, named).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def date_spine(*dates: DataFrame) -> DataFrame:
    """Every day from the smallest to the largest date found in the given one-column frames."""
    days = F.sequence("first_date", "last_date", F.expr("interval 1 day"))
    return date_bounds(*dates).select(F.explode(days).alias("date"))


def dim_date(spine: DataFrame) -> DataFrame:
    """The date dimension: one row per day of ``spine``, keyed by the number yyyymmdd."""
    day = F.col("date")
    weekday = F.dayofweek(day)
    return spine.select(
        (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_short_name"),
        weekday.alias("day_of_week_number"),
        weekday.isin(1, 7).alias("is_weekend"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        (F.year(day) * 100 + F.month(day)).alias("year_month_number"),
    )


def date_levels(day: Column) -> list[Column]:
    """The levels of a date hierarchy: year, quarter, month and day, with the numbers that sort them."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month_no"),
        F.date_format(day, "MMMM").alias("month"),
        F.quarter(day).alias("quarter_no"),
        F.concat(F.lit("Qtr "), F.quarter(day)).alias("quarter"),
        F.dayofmonth(day).alias("day"),
    ]


def padded_calendar(df: DataFrame, column: str) -> DataFrame:
    """Whole years from the first to the last date of ``column``, with the levels of a date hierarchy."""
    year: Column = F.year(column)
    years = df.agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"))
    days = F.sequence(
        F.make_date("first_year", F.lit(1), F.lit(1)), F.make_date("last_year", F.lit(12), F.lit(31))
    )
    return years.select(F.explode(days).alias("date")).select("date", *date_levels(F.col("date")))


def join_date_part(df: DataFrame, column: str, calendar: DataFrame, how: str = "left") -> DataFrame:
    """Join a timestamp column to a calendar on its date part alone."""
    return df.join(calendar, F.to_date(column) == calendar["date"], how)
