"""The star schema: dimensions and facts with surrogate keys.

Joins carry no hints. Spark broadcasts a dimension only while its measured size is below the session's
threshold and otherwise sorts both sides, where adaptive execution splits a hot key such as the walk-in
customer. Every join keeps the rows of its left side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starledger.functions.scalars import full_name
from starledger.operators.calendar import date_spine, dim_date, order_date_mapping
from starledger.operators.keys import surrogate_key
from starledger.operators.reshape import drop_all_null_columns
from starledger.plans.star import MONTH
from starledger.session import releasing, stage

# Columns of the dimensions and facts, in order, after their surrogate key.
CUSTOMER_COLUMNS = (
    "customer_id", "reference_id", "customer_name", "given_name", "family_name", "email_address", "phone_number",
    "created_at", "updated_at", "address_district", "address_locality", "address_postal_code", "address_country",
)
PRODUCT_COLUMNS = (
    "variation_id", "item_id", "item_name", "description", "product_type", "variation_name", "sku", "ordinal",
    "price_amount", "currency", "pricing_type", "sellable", "stockable", "is_archived", "is_taxable",
    "is_variation_deleted", "is_item_deleted", "present_at_all_locations", "created_at", "updated_at", "version",
)
ORDER_KEYS = ("date_key", "customer_key", "location_key")
ORDER_MEASURES = (
    "total_amount", "total_tax_amount", "total_discount_amount", "total_tip_amount", "total_service_charge_amount",
    "total_card_surcharge_amount", "net_total_amount", "net_tax_amount", "net_discount_amount", "net_tip_amount",
    "net_service_charge_amount", "net_card_surcharge_amount", "net_amount_due",
)
ORDER_COLUMNS = (
    "order_id", "business_order_id", "date_key", "customer_key", "location_key", "order_state", "order_version",
    "currency", "created_at", "updated_at", "closed_at", *ORDER_MEASURES,
)
SALES_COLUMNS = (
    "order_key", "date_key", "customer_key", "product_key", "location_key", "order_id", "business_order_id",
    "order_line_id", "variation_id", "item_name", "variation_name", "item_type", "quantity", "unit_price",
    "gross_sales_amount", "discount_amount", "tax_amount", "service_charge_amount", "card_surcharge_amount",
    "total_amount", "variation_total_price_amount", "currency",
)
PAYMENT_COLUMNS = (
    "order_key", "date_key", "customer_key", "location_key", "payment_id", "order_id", "customer_id", "amount",
    "currency", "total_amount", "total_currency", "payment_status", "payment_source_type", "created_at", "updated_at",
    "receipt_number", "external_source", "external_type", "card_brand", "card_type", "card_last_4",
    "card_entry_method", "card_status", "avs_status", "cvv_status", "cash_buyer_supplied_amount",
    "cash_change_back_amount", "risk_level", "application_id", "application_product", "version_token",
)
INVENTORY_COLUMNS = (
    "date_key", "product_key", "location_key", "variation_id", "location_id", "catalog_object_type",
    "inventory_state", "quantity", "inventory_date", "calculated_at",
)

# The columns that every fact is joined and numbered by: of its silver table, and of itself.
JOINED_BY = {
    "fact_order": ("order_id", "customer_id", "location_id"),
    "fact_sales": ("order_id", "order_line_id", "variation_id"),
    "fact_payment": ("payment_id", "order_id"),
    "fact_inventory": ("variation_id", "location_id", "inventory_state", "quantity", "calculated_at"),
}
NUMBERED_BY = {
    "fact_order": ("order_id",),
    "fact_sales": ("order_id", "order_line_id"),
    "fact_payment": ("payment_id",),
    # Counts of one day follow in order of their columns.
    "fact_inventory": ("variation_id", "location_id", "inventory_date", "inventory_state", "quantity", "calculated_at"),
}
FACT_COLUMNS = {
    "fact_order": ORDER_COLUMNS, "fact_sales": SALES_COLUMNS, "fact_payment": PAYMENT_COLUMNS, "fact_inventory": INVENTORY_COLUMNS,
}


def build_date_mapping(mapping: DataFrame) -> DataFrame:
    """The reporting date per business order, as the star uses it."""
    return mapping.select("business_order_id", "order_id", F.col("reporting_date").cast("date"))


def build_dim_date(mapping: DataFrame, inventory: DataFrame) -> DataFrame:
    """All days between the first and last reporting or stock date."""
    return dim_date(date_spine(mapping.select("reporting_date"), inventory.select(F.to_date("calculated_at"))))


def customer_attributes(customer: DataFrame) -> DataFrame:
    """Customers with their full name, in dimension order."""
    named = customer.withColumn("customer_name", full_name(F.col("given_name"), F.col("family_name")))
    return named.select(*CUSTOMER_COLUMNS)


def build_dim_customer(customer: DataFrame) -> DataFrame:
    return surrogate_key(customer_attributes(customer), ["customer_id"], "customer_key")


def join_product(variation: DataFrame, item: DataFrame) -> DataFrame:
    """Variations with the attributes of their item."""
    parents = item.select(
        "item_id", "item_name", "description", "product_type", "is_archived", "is_taxable",
        F.col("is_deleted").alias("is_item_deleted"),
    )
    joined = variation.withColumnRenamed("is_deleted", "is_variation_deleted").join(parents, "item_id", "left")
    return joined.select(*PRODUCT_COLUMNS)


def build_dim_product(variation: DataFrame, item: DataFrame) -> DataFrame:
    return surrogate_key(join_product(variation, item), ["variation_id"], "product_key")


def build_dim_location(location: DataFrame) -> DataFrame:
    """Locations as they are, without columns that hold no value; those that reports name stay."""
    return surrogate_key(drop_all_null_columns(location, ["location_id", "location_name", "state"]), ["location_id"], "location_key")


def _matched(rows: DataFrame, side: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows left-joined to ``side``, with those of its columns that ``columns`` names.

    Where it names none, the join only repeats rows whose key ``side`` holds more than once. Those keys are then
    counted and stored first: mostly few or none, so that Spark broadcasts them by the size of their file and ``rows``
    stay where they are. Many of them meet ``rows`` in a shuffle as ``side`` would.
    """
    if any(c in columns for c in side.columns if c != key):
        return rows.join(side, key, "left")
    repeated = side.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").cast("int").alias("__times")).filter("__times > 1")
    times = F.explode(F.sequence(F.lit(1), F.coalesce("__times", F.lit(1))))
    return rows.join(stage(repeated, "repeated"), key, "left").withColumn("__times", times).drop("__times")


def join_order(
    header: DataFrame, mapping: DataFrame, customer: DataFrame, location: DataFrame, date: DataFrame,
    columns: Sequence[str] = ORDER_COLUMNS,
) -> DataFrame:
    """Order headers with the keys of their date, customer and location.

    The mapping is joined by order id, so where orders share a business id only the mapped one gets a date.
    """
    days = date.select(F.col("date").alias("reporting_date"), "date_key")
    dated = mapping.select("order_id", "reporting_date").join(days, "reporting_date", "left").drop("reporting_date")
    rows = _matched(header, dated, "order_id", columns)
    rows = _matched(rows, customer.select("customer_id", "customer_key"), "customer_id", columns)
    return rows.join(location.select("location_id", "location_key"), "location_id", "left").select(*columns)


def by_month(fact: DataFrame) -> DataFrame:
    """A fact with the month of its date key, the column that facts are stored by.

    Days are packed into months so that files stay few and large; inside a month rows are sorted by day.
    """
    return fact.withColumn(MONTH, _month())


def _month() -> Column:
    return (F.col("date_key") / 100).cast("int")


def _numbered(joined: DataFrame, fact: str, name: str, keep: Sequence[str] | None, months: bool = False) -> DataFrame:
    """A fact with its surrogate key and, where it has a date key, its month. Rows of few columns carry them along.

    With ``months`` all rows do, and the copy of them that numbering writes lies in months, as :func:`by_month` has it.
    """
    kept = joined.columns if keep is None else keep
    dated = "date_key" in kept
    folders = {MONTH: _month()} if months and dated else None
    carry = bool(folders) or len(kept) < len(FACT_COLUMNS[fact])
    keyed = surrogate_key(joined, NUMBERED_BY[fact], name, carry=carry, keep=keep, folders=folders, sort_by=("date_key",) if folders else ())
    return by_month(keyed) if dated and not folders else keyed


def build_fact_order(
    header: DataFrame, mapping: DataFrame, customer: DataFrame, location: DataFrame, date: DataFrame,
    columns: Sequence[str] = ORDER_COLUMNS, keep: Sequence[str] | None = None, months: bool = False,
) -> DataFrame:
    """Orders in order of their ids. Here and below, ``columns`` are those to number by, ``keep`` what the fact has of them.

    ``months``: whether the copy that numbering writes lies in months.
    """
    return _numbered(join_order(header, mapping, customer, location, date, columns), "fact_order", "order_key", keep, months)


def _order_keys(fact_order: DataFrame) -> DataFrame:
    """The keys that a fact of orders has; one of fewer columns may lack some."""
    return fact_order.select("order_id", "order_key", *[k for k in ORDER_KEYS if k in fact_order.columns])


def join_sales(line: DataFrame, fact_order: DataFrame, product: DataFrame, columns: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """Order lines with the keys of their order and product."""
    rows = _matched(line, _order_keys(fact_order), "order_id", columns)
    return _matched(rows, product.select("variation_id", "product_key"), "variation_id", columns).select(*columns)


def build_fact_sales(
    line: DataFrame, fact_order: DataFrame, product: DataFrame,
    columns: Sequence[str] = SALES_COLUMNS, keep: Sequence[str] | None = None, months: bool = False,
) -> DataFrame:
    return _numbered(join_sales(line, fact_order, product, columns), "fact_sales", "sales_key", keep, months)


def join_payment(payment: DataFrame, fact_order: DataFrame, columns: Sequence[str] = PAYMENT_COLUMNS) -> DataFrame:
    """Payments with the keys of their order."""
    return _matched(payment, _order_keys(fact_order), "order_id", columns).select(*columns)


def build_fact_payment(
    payment: DataFrame, fact_order: DataFrame, columns: Sequence[str] = PAYMENT_COLUMNS, keep: Sequence[str] | None = None, months: bool = False
) -> DataFrame:
    return _numbered(join_payment(payment, fact_order, columns), "fact_payment", "payment_key", keep, months)


def join_inventory(
    inventory: DataFrame, product: DataFrame, location: DataFrame, date: DataFrame, columns: Sequence[str] = INVENTORY_COLUMNS
) -> DataFrame:
    """Stock counts with the keys of their product, location and day."""
    dated = inventory.withColumn("inventory_date", F.to_date("calculated_at"))
    return (
        _matched(dated, product.select("variation_id", "product_key"), "variation_id", columns)
        .join(location.select("location_id", "location_key"), "location_id", "left")
        .join(date.select(F.col("date").alias("inventory_date"), "date_key"), "inventory_date", "left")
        .select(*columns)
    )


def build_fact_inventory(
    inventory: DataFrame, product: DataFrame, location: DataFrame, date: DataFrame,
    columns: Sequence[str] = INVENTORY_COLUMNS, keep: Sequence[str] | None = None, months: bool = False,
) -> DataFrame:
    """Stock counts keyed by variation, location and day. Counts of one day follow in order of their columns."""
    return _numbered(join_inventory(inventory, product, location, date, columns), "fact_inventory", "inventory_key", keep, months)


# Every gold table: how it is built and the tables it is built from, in build order.
STAR: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "order_date_mapping": (lambda header: build_date_mapping(order_date_mapping(header)), ("order_header",)),
    "dim_date": (build_dim_date, ("order_date_mapping", "inventory")),
    "dim_customer": (build_dim_customer, ("customer",)),
    "dim_product": (build_dim_product, ("catalog_variation", "catalog_item")),
    "dim_location": (build_dim_location, ("location",)),
    "fact_order": (
        build_fact_order,
        ("order_header", "order_date_mapping", "dim_customer", "dim_location", "dim_date"),
    ),
    "fact_sales": (build_fact_sales, ("order_line", "fact_order", "dim_product")),
    "fact_payment": (build_fact_payment, ("payment", "fact_order")),
    "fact_inventory": (build_fact_inventory, ("inventory", "dim_product", "dim_location", "dim_date")),
}


# How the facts are stored: see :func:`starledger.sources.tables.write_table`.
LAYOUT = {
    name: {"partition_by": (MONTH,), "sort_by": ("date_key",)} for name in ("fact_order", "fact_sales", "fact_payment", "fact_inventory")
}


def build_star(silver: dict[str, DataFrame], save: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """All gold tables from the silver ones. ``save`` stores a table and returns it as read back.

    Each table is stored before others are built on it, so none is computed twice. Intermediate copies are
    deleted as soon as the table made of them is stored.
    """
    tables = dict(silver)
    for name, (build, sources) in STAR.items():
        with releasing(tables[sources[0]].sparkSession):
            tables[name] = save(name, build(*[tables[s] for s in sources]))
    return {name: tables[name] for name in STAR}
