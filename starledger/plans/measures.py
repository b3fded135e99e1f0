"""The measures over the star.

Sales are shown in major units, payment amounts in minor units as stored. Distinct counts count NULL as a
value. A division by zero or NULL gives NULL unless another value is stated.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starledger.functions.scalars import distinct_with_null, major_units, ratio
from starledger.plans.star import Filters, Measure, Part, Tables, evaluate

COMPLETED = "COMPLETED"


def _sum(column: str):
    return lambda: F.sum(column)


def _distinct(table: str, column: str, where=None, replaces: str | None = None, reads: Sequence[str] = ()) -> Part:
    """The number of distinct values of a column, of the rows that ``where`` selects by the columns ``reads``."""
    value = lambda: distinct_with_null(F.col(column), where() if where else None)
    return Part(table, value, replaces=replaces, distinct=column, where=where, reads=(column, *reads))


PARTS = {
    "sales_amount": Part("fact_sales", _sum("total_amount"), merge="sum", reads=("total_amount",)),
    "sales_day_before": Part("fact_sales", _sum("total_amount"), merge="sum", back="day", reads=("total_amount",)),
    "sales_month_before": Part("fact_sales", _sum("total_amount"), merge="sum", back="month", reads=("total_amount",)),
    "sales_quantity": Part("fact_sales", _sum("quantity"), merge="sum", reads=("quantity",)),
    "sales_products": _distinct("fact_sales", "product_key"),
    "sales_days": _distinct("fact_sales", "date_key"),
    "orders": _distinct("fact_order", "order_id"),
    "buyers": _distinct("fact_order", "customer_key"),
    "returning": Part(
        "fact_order",
        lambda: F.count_if(F.col("inner_value") > 1),
        per="customer_key",
        inner=lambda: F.count_distinct("order_key"),
        distinct="order_key",
        reads=("customer_key", "order_key"),
    ),
    "customers": _distinct("dim_customer", "customer_key"),
    "payments": _distinct("fact_payment", "payment_key"),
    "payment_amount": Part("fact_payment", _sum("amount"), merge="sum", reads=("amount",)),
    "payments_completed": _distinct(
        "fact_payment", "payment_key", lambda: F.col("payment_status") == COMPLETED, replaces="fact_payment.payment_status",
        reads=("payment_status",),
    ),
    "stock": Part("fact_inventory", _sum("quantity"), merge="sum", reads=("quantity",)),
    "stock_in": _distinct("fact_inventory", "product_key", lambda: F.col("quantity") > 0, reads=("quantity",)),
    "stock_out": _distinct("fact_inventory", "product_key", lambda: F.col("quantity") <= 0, reads=("quantity",)),
    "stock_mean": Part(
        "fact_inventory", lambda: F.avg("inner_value"), per="product_key", inner=lambda: F.sum("quantity"), merge="sum",
        reads=("product_key", "quantity"),
    ),
    "stock_max": Part("fact_inventory", lambda: F.max("quantity"), merge="max", reads=("quantity",)),
    "stock_min": Part("fact_inventory", lambda: F.min("quantity"), merge="min", reads=("quantity",)),
}


def _zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def _same(column: Column) -> Column:
    return column


def growth(value: Column, previous: Column) -> Column:
    """Change against the previous value as a fraction; a missing value counts as zero."""
    return ratio(F.coalesce(value, F.lit(0.0)) - previous, previous)


def _sales_per(amount: Column, count: Column) -> Column:
    return ratio(major_units(amount), count)


MEASURES = {
    "total_sales": Measure(("sales_amount",), major_units),
    "total_orders": Measure(("orders",), _same),
    "total_quantity_sold": Measure(("sales_quantity",), _same),
    "average_order_value": Measure(
        ("sales_amount", "orders"), lambda a, n: ratio(major_units(a), n, F.lit(0.0)), never_blank=True
    ),
    "total_customers": Measure(("customers",), _same),
    "customers_with_orders": Measure(("buyers",), _same),
    "repeat_customers": Measure(("returning",), _zero, never_blank=True),
    "sales_per_customer": Measure(("sales_amount", "buyers"), _sales_per),
    "total_payments": Measure(("payments",), _same),
    "total_payment_amount": Measure(("payment_amount",), _same),
    "average_payment_value": Measure(("payment_amount", "payments"), ratio),
    "completed_payments": Measure(("payments_completed",), _same),
    "payment_success_rate": Measure(("payments_completed", "payments"), ratio),
    "total_inventory_quantity": Measure(("stock",), _same),
    "products_in_stock": Measure(("stock_in",), _same),
    "out_of_stock_products": Measure(("stock_out",), _zero, never_blank=True),
    "average_inventory_quantity": Measure(("stock_mean",), _same),
    "maximum_inventory_quantity": Measure(("stock_max",), _same),
    "minimum_inventory_quantity": Measure(("stock_min",), _same),
    "items_per_order": Measure(("sales_quantity", "orders"), ratio),
    "customer_purchase_frequency": Measure(("orders", "buyers"), ratio),
    "sales_per_product": Measure(("sales_amount", "sales_products"), _sales_per),
    # An average per day with sales, despite its name.
    "daily_sales": Measure(("sales_amount", "sales_days"), _sales_per),
    "previous_day_sales": Measure(("sales_day_before",), major_units),
    "daily_sales_growth_pct": Measure(("sales_amount", "sales_day_before"), lambda a, b: growth(major_units(a), major_units(b))),
    "previous_month_sales": Measure(("sales_month_before",), major_units),
    "monthly_sales_growth_pct": Measure(("sales_amount", "sales_month_before"), lambda a, b: growth(major_units(a), major_units(b))),
    "repeat_customer_rate": Measure(("returning", "buyers"), lambda r, n: F.coalesce(ratio(_zero(r), n), F.lit(0.0)), never_blank=True),
}


def measure(
    tables: Tables, measures: str | Sequence[str], group_by: Sequence[str] = (), filters: Filters | None = None,
    reads: Mapping[str, Collection[str]] | None = None,
) -> DataFrame:
    """Evaluate measures by name; see :func:`starledger.plans.star.evaluate`."""
    wanted = [measures] if isinstance(measures, str) else list(measures)
    return evaluate(tables, (PARTS, MEASURES), wanted, group_by, filters, reads)


# -- sales against an earlier period ---------------------------------------------------------------


def _back(unit: str) -> Column:
    return F.date_sub("date", 1) if unit == "day" else F.add_months("date", -1)


def daily_totals(tables: Tables, filters: Filters | None = None) -> DataFrame:
    """Total sales per date."""
    return measure(tables, "total_sales", ["dim_date.date"], filters)


def previous_period(daily: DataFrame, calendar: DataFrame, unit: str) -> DataFrame:
    """Per date: total sales, those one ``unit`` (day or month) earlier, and the growth.

    The earlier date is found in the calendar, so gaps give NULL. A day that the earlier month lacks falls on
    its last day. All inputs hold one row per date.
    """
    known = daily.filter(F.col("date").isNotNull())
    earlier = known.select(F.col("date").alias("earlier_date"), F.col("total_sales").alias("previous_sales"))
    return (
        calendar.select("date", _back(unit).alias("earlier_date"))
        .join(known, "date", "left")
        .join(earlier, "earlier_date", "left")
        .filter(F.coalesce("total_sales", "previous_sales").isNotNull())
        .select(
            "date",
            "total_sales",
            "previous_sales",
            growth(F.col("total_sales"), F.col("previous_sales")).alias("growth"),
        )
    )


def previous_month(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per calendar month: total sales, those of the whole month before, and the growth."""
    month = (F.year("date") * 12 + F.month("date")).alias("month_index")
    money = F.sum(F.col("total_sales").cast("decimal(38,2)")).cast("double")
    monthly = daily.filter(F.col("date").isNotNull()).groupBy(month).agg(money.alias("total_sales"))
    earlier = monthly.select(F.col("month_index") + 1, F.col("total_sales")).toDF("month_index", "previous_sales")
    months = calendar.groupBy(month).agg(F.min(F.year("date") * 100 + F.month("date")).alias("year_month_number"))
    return (
        months.join(monthly, "month_index", "left")
        .join(earlier, "month_index", "left")
        .filter(F.coalesce("total_sales", "previous_sales").isNotNull())
        .select(
            "year_month_number",
            "total_sales",
            "previous_sales",
            growth(F.col("total_sales"), F.col("previous_sales")).alias("growth"),
        )
    )


def previous_total(daily: DataFrame, calendar: DataFrame, unit: str) -> DataFrame:
    """One row: total sales, and sales on all calendar dates moved back by one ``unit``."""
    known = daily.filter(F.col("date").isNotNull())
    money = F.col("total_sales").cast("decimal(38,2)")
    moved = calendar.select(_back(unit).alias("date")).distinct()
    earlier = known.join(moved, "date", "left_semi")
    both = daily.select(money.alias("now"), F.lit(None).cast("decimal(38,2)").alias("before")).unionAll(
        earlier.select(F.lit(None).cast("decimal(38,2)"), money)
    )
    summed = both.agg(
        F.sum("now").cast("double").alias("total_sales"), F.sum("before").cast("double").alias("previous_sales")
    )
    return summed.withColumn("growth", growth(F.col("total_sales"), F.col("previous_sales")))
