"""The report's queries over the star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from starledger.operators.calendar import date_levels
from starledger.plans.measures import measure
from starledger.plans.star import Filters, Tables

ITEM = "dim_product.item_name"

# The single-value cards of the report's three pages.
CARDS = {
    "sales_overview": (
        "total_sales",
        "total_orders",
        "total_quantity_sold",
        "average_order_value",
        "total_customers",
    ),
    "customers_and_payments": (
        "repeat_customers",
        "repeat_customer_rate",
        "sales_per_customer",
        "customers_with_orders",
    ),
    "products_and_inventory": (
        "average_inventory_quantity",
        "products_in_stock",
        "total_inventory_quantity",
        "out_of_stock_products",
    ),
}

# How the model summarises a column when no measure is chosen.
DEFAULT_SUMS = {
    "dim_date": (
        "year", "quarter_number", "month_number", "week_of_year", "day_of_month", "day_of_week_number",
        "year_month_number",
    ),
    "dim_product": (
        "ordinal", "price_amount", "version",
    ),
    "fact_inventory": (
        "quantity",
    ),
    "fact_order": (
        "order_version", "total_amount", "total_tax_amount", "total_discount_amount", "total_tip_amount",
        "total_service_charge_amount", "total_card_surcharge_amount", "net_total_amount", "net_tax_amount",
        "net_discount_amount", "net_tip_amount", "net_service_charge_amount", "net_card_surcharge_amount",
        "net_amount_due",
    ),
    "fact_payment": (
        "amount", "total_amount", "cash_buyer_supplied_amount", "cash_change_back_amount",
    ),
    "fact_sales": (
        "quantity", "unit_price", "gross_sales_amount", "discount_amount", "tax_amount", "service_charge_amount",
        "card_surcharge_amount", "total_amount", "variation_total_price_amount",
    ),
}
DEFAULT_COUNTS = {
    "fact_inventory": (
        "inventory_key",
    ),
    "fact_order": (
        "order_key",
    ),
    "fact_payment": (
        "payment_key", "order_key",
    ),
    "fact_sales": (
        "sales_key", "order_key", "product_key",
    ),
}


def between_dates(first: dt.date | str, last: dt.date | str) -> Filters:
    """The date slicer: from the first to the last date, both included, as a filter on the date dimension."""
    date = F.col("date")
    after = F.date_add(F.lit(str(last)).cast("date"), 1)
    return {"dim_date": (date >= F.lit(str(first)).cast("date")) & (date < after)}


def cards(tables: Tables, page: str, filters: Filters | None = None) -> DataFrame:
    """One row: the single-value cards of a page."""
    return measure(tables, CARDS[page], (), filters)


def top_n(df: DataFrame, value: str, n: int = 10) -> DataFrame:
    """Rows with the ``n`` greatest values; ties with the last of them stay.

    The n-th value is found by a top-n that each task does for itself first. Rows are then compared with it
    where they are, so nothing is ranked in one task however many rows or ties there are.
    """
    # Inside a struct NULL is the smallest value, so it ranks last and still ties with itself.
    boxed = F.struct(F.col(value).alias("v"))
    lowest = df.select(boxed.alias("boxed")).orderBy(F.desc("boxed")).limit(n).agg(F.min("boxed")).scalar()
    return df.filter(boxed >= lowest)


def sales_by_date(tables: Tables, filters: Filters | None = None) -> DataFrame:
    return measure(tables, "total_sales", ["dim_date.date"], filters).orderBy("date")


def quantity_by_item(tables: Tables, filters: Filters | None = None) -> DataFrame:
    return measure(tables, "total_quantity_sold", [ITEM], filters).orderBy(F.desc("total_quantity_sold"), "item_name")


def top10_items_by_sales(tables: Tables, filters: Filters | None = None) -> DataFrame:
    best = top_n(measure(tables, "total_sales", [ITEM], filters), "total_sales")
    return best.orderBy(F.desc("total_sales"), "item_name")


def top10_customers_by_sales(tables: Tables, filters: Filters | None = None) -> DataFrame:
    best = top_n(measure(tables, "total_sales", ["dim_customer.customer_name"], filters), "total_sales")
    return best.orderBy(F.desc("total_sales"), "customer_name")


def sales_by_locality(tables: Tables, filters: Filters | None = None) -> DataFrame:
    by = measure(tables, "total_sales", ["dim_customer.address_locality"], filters)
    return by.orderBy(F.desc("total_sales"), "address_locality")


def payments_by_source(tables: Tables, filters: Filters | None = None) -> DataFrame:
    by = measure(tables, "total_payments", ["fact_payment.payment_source_type"], filters)
    return by.orderBy(F.desc("total_payments"), "payment_source_type")


def sales_by_payment_status(tables: Tables, filters: Filters | None = None) -> DataFrame:
    """Total sales under each payment status. Sales have no path to payments, so each shows the grand total."""
    by = measure(tables, "total_sales", ["fact_payment.payment_status"], filters)
    return by.orderBy(F.desc("total_sales"), "payment_status")


def inventory_by_item(tables: Tables, filters: Filters | None = None) -> DataFrame:
    by = measure(tables, "total_inventory_quantity", [ITEM], filters)
    return by.orderBy(F.desc("total_inventory_quantity"), "item_name")


def product_table(tables: Tables, filters: Filters | None = None) -> DataFrame:
    """Per item: quantity sold, sales and stock, from two facts."""
    return measure(tables, ["total_quantity_sold", "total_sales", "total_inventory_quantity"], [ITEM], filters)


def default_summary(tables: Tables, table: str) -> DataFrame:
    """One row: every column of a table that has a default summary, under it."""
    sums: list[Column] = [F.sum(c).alias(f"sum_{c}") for c in DEFAULT_SUMS.get(table, ())]
    counts: list[Column] = [F.count(c).alias(f"count_{c}") for c in DEFAULT_COUNTS.get(table, ())]
    return tables[table].agg(*sums, *counts)


def hierarchy_rollup(df: DataFrame, date_column: str, value: str, name: str) -> DataFrame:
    """Sums of ``value`` at each level of a date hierarchy: year, quarter, month, day and the total.

    Rows are summed per day first; only days are rolled up.
    """
    per_day = df.groupBy(F.to_date(date_column).alias("date")).agg(F.sum(value).alias("value"))
    levels = per_day.filter(F.col("date").isNotNull()).select(*date_levels(F.col("date")), "value")
    return levels.rollup("year", "quarter", "month", "day").agg(
        F.sum("value").alias(name), F.grouping_id().alias("level_id")
    )
