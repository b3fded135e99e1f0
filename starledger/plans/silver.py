"""Typed flat tables from raw records, one grain each.

A raw frame has one envelope per row. Tables are described as data: target column, path in the record, type.
A path the schema lacks gives a NULL column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from starledger.functions.scalars import bool_text, first_element, first_or_default, first_truthy
from starledger.operators.keys import latest_per_key
from starledger.operators.reshape import (
    drop_all_null_columns,
    explode_children,
    explode_records,
    project,
    safe_col,
)

Fields = list[tuple[str, str, str]]


def fields(text: str) -> Fields:
    """Parse a field table: one ``target path type`` per line."""
    return [tuple(line.split()) for line in text.strip().splitlines()]


# Target column, path in the raw record, type.
ORDER_HEADER = fields("""
order_id                       id                                       string
business_order_id              reference_id                             string
location_id                    location_id                              string
customer_id                    customer_id                              string
order_state                    state                                    string
order_version                  version                                  bigint
created_at                     created_at                               timestamp
updated_at                     updated_at                               timestamp
closed_at                      closed_at                                timestamp
total_amount                   total_money.amount                       bigint
currency                       total_money.currency                     string
total_tax_amount               total_tax_money.amount                   bigint
total_discount_amount          total_discount_money.amount              bigint
total_tip_amount               total_tip_money.amount                   bigint
total_service_charge_amount    total_service_charge_money.amount        bigint
total_card_surcharge_amount    total_card_surcharge_money.amount        bigint
net_total_amount               net_amounts.total_money.amount           bigint
net_tax_amount                 net_amounts.tax_money.amount             bigint
net_discount_amount            net_amounts.discount_money.amount        bigint
net_tip_amount                 net_amounts.tip_money.amount             bigint
net_service_charge_amount      net_amounts.service_charge_money.amount  bigint
net_card_surcharge_amount      net_amounts.card_surcharge_money.amount  bigint
net_amount_due                 net_amount_due_money.amount              bigint
source_name                    source.name                              string
""")

ORDER_LINE = fields("""
order_line_id                  uid                                      string
variation_id                   catalog_object_id                        string
catalog_version                catalog_version                          bigint
item_name                      name                                     string
variation_name                 variation_name                           string
item_type                      item_type                                string
quantity                       quantity                                 decimal(18,3)
unit_price                     base_price_money.amount                  bigint
currency                       base_price_money.currency                string
gross_sales_amount             gross_sales_money.amount                 bigint
discount_amount                total_discount_money.amount              bigint
tax_amount                     total_tax_money.amount                   bigint
service_charge_amount          total_service_charge_money.amount        bigint
card_surcharge_amount          total_card_surcharge_money.amount        bigint
total_amount                   total_money.amount                       bigint
variation_total_price_amount   variation_total_price_money.amount       bigint
""")

ORDER_TENDER = fields("""
tender_id                      id                                               string
payment_id                     payment_id                                       string
transaction_id                 transaction_id                                   string
created_at                     created_at                                       timestamp
amount                         amount_money.amount                              bigint
currency                       amount_money.currency                            string
tender_type                    type                                             string
payment_source                 other_details.source                             string
tender_status                  other_details.status                             string
card_brand                     card_details.card.card_brand                     string
card_type                      card_details.card.card_type                      string
card_last_4                    card_details.card.last_4                         string
card_entry_method              card_details.entry_method                        string
card_status                    card_details.status                              string
cash_buyer_tendered_amount     cash_details.buyer_tendered_money.amount         bigint
cash_change_back_amount        cash_details.change_back_money.amount            bigint
""")

PAYMENT = fields("""
payment_id                     id                                       string
order_id                       order_id                                 string
customer_id                    customer_id                              string
location_id                    location_id                              string
amount                         amount_money.amount                      bigint
currency                       amount_money.currency                    string
total_amount                   total_money.amount                       bigint
total_currency                 total_money.currency                     string
payment_status                 status                                   string
payment_source_type            source_type                              string
created_at                     created_at                               timestamp
updated_at                     updated_at                               timestamp
receipt_number                 receipt_number                           string
external_source                external_details.source                  string
external_type                  external_details.type                    string
card_brand                     card_details.card.card_brand             string
card_type                      card_details.card.card_type              string
card_last_4                    card_details.card.last_4                 string
card_entry_method              card_details.entry_method                string
card_status                    card_details.status                      string
avs_status                     card_details.avs_status                  string
cvv_status                     card_details.cvv_status                  string
cash_buyer_supplied_amount     cash_details.buyer_supplied_money.amount bigint
cash_change_back_amount        cash_details.change_back_money.amount    bigint
risk_level                     risk_evaluation.risk_level               string
application_id                 application_details.application_id       string
application_product            application_details.product              string
version_token                  version_token                            string
""")

# The wider payment table: approval, delay and card timeline on top of the above.
PAYMENT_DETAIL = PAYMENT + fields("""
receipt_url                    receipt_url                                          string
delay_action                   delay_action                                         string
delay_duration                 delay_duration                                       string
delayed_until                  delayed_until                                        timestamp
approved_amount                approved_money.amount                                bigint
approved_currency              approved_money.currency                              string
card_exp_month                 card_details.card.exp_month                          int
card_exp_year                  card_details.card.exp_year                           int
card_fingerprint               card_details.card.fingerprint                        string
card_prepaid_type              card_details.card.prepaid_type                       string
auth_result_code               card_details.auth_result_code                        string
statement_description          card_details.statement_description                   string
authorized_at                  card_details.card_payment_timeline.authorized_at     timestamp
captured_at                    card_details.card_payment_timeline.captured_at       timestamp
cash_buyer_supplied_currency   cash_details.buyer_supplied_money.currency           string
""")

PROCESSING_FEE = fields("""
processing_fee_effective_at    effective_at                             timestamp
processing_fee_type            type                                     string
processing_fee_amount          amount_money.amount                      bigint
processing_fee_currency        amount_money.currency                    string
""")

CUSTOMER = fields("""
customer_id                    id                                       string
reference_id                   reference_id                             string
given_name                     given_name                               string
family_name                    family_name                              string
email_address                  email_address                            string
phone_number                   phone_number                             string
created_at                     created_at                               timestamp
updated_at                     updated_at                               timestamp
creation_source                creation_source                          string
address_district               address.administrative_district_level_1  string
address_locality               address.locality                         string
address_postal_code            address.postal_code                      string
address_country                address.country                          string
email_unsubscribed             preferences.email_unsubscribed           boolean
""")

CUSTOMER_DETAIL = CUSTOMER + fields("""
company_name                   company_name                             string
note                           note                                     string
address_line_1                 address.address_line_1                   string
address_line_2                 address.address_line_2                   string
""")

CATALOG_ITEM = fields("""
item_id                        id                                       string
item_name                      item_data.name                           string
description                    item_data.description                    string
product_type                   item_data.product_type                   string
is_archived                    item_data.is_archived                    boolean
is_taxable                     item_data.is_taxable                     boolean
is_deleted                     is_deleted                               boolean
created_at                     created_at                               timestamp
updated_at                     updated_at                               timestamp
version                        version                                  bigint
""")

CATALOG_VARIATION = fields("""
variation_id                   id                                       string
item_id                        item_variation_data.item_id              string
variation_name                 item_variation_data.name                 string
sku                            item_variation_data.sku                  string
ordinal                        item_variation_data.ordinal              bigint
price_amount                   item_variation_data.price_money.amount   bigint
currency                       item_variation_data.price_money.currency string
pricing_type                   item_variation_data.pricing_type         string
sellable                       item_variation_data.sellable             boolean
stockable                      item_variation_data.stockable            boolean
is_deleted                     is_deleted                               boolean
present_at_all_locations       present_at_all_locations                 boolean
created_at                     created_at                               timestamp
updated_at                     updated_at                               timestamp
version                        version                                  bigint
""")

CATEGORY = fields("""
category_id                    id                                       string
type                           type                                     string
version                        version                                  bigint
is_deleted                     is_deleted                               boolean
present_at_all_locations       present_at_all_locations                 boolean
created_at                     created_at                               timestamp
updated_at                     updated_at                               timestamp
category_name                  category_data.name                       string
is_top_level                   category_data.is_top_level               boolean
online_visibility              category_data.online_visibility          boolean
category_type                  category_data.category_type              string
parent_category_id             category_data.parent_category.id         string
""")

INVENTORY = fields("""
variation_id                   catalog_object_id                        string
catalog_object_type            catalog_object_type                      string
inventory_state                state                                    string
location_id                    location_id                              string
quantity                       quantity                                 bigint
calculated_at                  calculated_at                            timestamp
""")

EMPLOYEE = fields("""
employee_id                    id                                       string
first_name                     first_name                               string
last_name                      last_name                                string
email                          email                                    string
phone_number                   phone_number                             string
employee_status                status                                   string
created_at                     created_at                               timestamp
updated_at                     updated_at                               timestamp
""")

LOCATION = fields("""
location_id                    id                                       string
location_name                  name                                     string
business_name                  business_name                            string
location_status                status                                   string
location_type                  type                                     string
address_line_1                 address.address_line_1                   string
address_line_2                 address.address_line_2                   string
city                           address.locality                         string
state                          address.administrative_district_level_1  string
postal_code                    address.postal_code                      string
country                        address.country                          string
timezone                       timezone                                 string
currency                       currency                                 string
language_code                  language_code                            string
created_at                     created_at                               timestamp
updated_at                     updated_at                               timestamp
""")

LOCATION_DETAIL = fields("""
merchant_id                    merchant_id                              string
phone_number                   phone_number                             string
website_url                    website_url                              string
description                    description                              string
business_country               country                                  string
latitude                       coordinates.latitude                     double
longitude                      coordinates.longitude                    double
mcc                            mcc                                      string
""")


def _of_order(raw: DataFrame, array: str, location: str = "location_id", outer: bool = True) -> DataFrame:
    orders = explode_records(raw, "orders")
    keys = {
        "order_id": F.col("record.id"),
        "business_order_id": F.col("record.reference_id"),
        location: F.col("record.location_id"),
    }
    return explode_children(orders, keys, f"record.{array}", outer=outer)


def flatten_order_header(raw: DataFrame) -> DataFrame:
    """One row per order."""
    return project(explode_records(raw, "orders"), "record", ORDER_HEADER)


def flatten_order_line(raw: DataFrame, outer: bool = True) -> DataFrame:
    """One row per order line; with ``outer`` an order without lines keeps one row without a line."""
    lines = _of_order(raw, "line_items", outer=outer)
    return project(lines, "child", ORDER_LINE, keep=["order_id", "business_order_id", "location_id"])


def flatten_order_tender(raw: DataFrame) -> DataFrame:
    """One row per tender; an order without tenders keeps one row without a tender."""
    tenders = _of_order(raw, "tenders", location="order_location_id")
    return project(tenders, "child", ORDER_TENDER, keep=["order_id", "business_order_id", "order_location_id"])


def at_paths(fields: Fields, paths: Mapping[str, str] | None) -> Fields:
    """A field table with other paths for some of its columns, for feeds that name their fields differently."""
    unknown = set(paths or {}) - {name for name, _, _ in fields}
    if unknown:
        raise ValueError(f"not columns of the table: {sorted(unknown)}")
    return [(name, (paths or {}).get(name, path), to) for name, path, to in fields]


def flatten_payment(raw: DataFrame, detail: bool = False, paths: Mapping[str, str] | None = None) -> DataFrame:
    """One row per payment. ``paths`` gives other paths in the record for named columns."""
    return project(explode_records(raw, "payments"), "record", at_paths(PAYMENT_DETAIL if detail else PAYMENT, paths))


def flatten_processing_fee(raw: DataFrame) -> DataFrame:
    """One row per fee of a payment; payments without fees give none."""
    payments = explode_records(raw, "payments")
    fees = explode_children(payments, {"payment_id": F.col("record.id")}, "record.processing_fee", outer=False)
    return project(fees, "child", PROCESSING_FEE, keep=["payment_id"])


def flatten_customer(raw: DataFrame, detail: bool = False) -> DataFrame:
    """One row per customer, with the first of the customer's segments."""
    records = explode_records(raw, "customers")
    typed = [safe_col(records.schema, f"record.{p}", n, t) for n, p, t in (CUSTOMER_DETAIL if detail else CUSTOMER)]
    segment = first_element(F.col("record.segment_ids")).alias("segment_id")
    return records.select(*typed, segment, safe_col(records.schema, "record.version", "version", "bigint"))


def _objects(raw: DataFrame, kind: str) -> DataFrame:
    return explode_records(raw, "objects").filter(F.col("record.type") == kind)


def flatten_catalog_item(raw: DataFrame) -> DataFrame:
    return project(_objects(raw, "ITEM"), "record", CATALOG_ITEM)


def flatten_catalog_variation(raw: DataFrame) -> DataFrame:
    return project(_objects(raw, "ITEM_VARIATION"), "record", CATALOG_VARIATION)


def flatten_category(raw: DataFrame) -> DataFrame:
    return project(_objects(raw, "CATEGORY"), "record", CATEGORY)


def flatten_item_variations(raw: DataFrame, outer: bool = True) -> DataFrame:
    """One row per variation nested in an item, with the item's first category.

    With ``outer`` an item without variations keeps one row with a NULL variation and its tax flag as it is;
    without it such items are left out and the flag is text.
    """
    item = F.col("record.item_data")
    keys = {
        "item_id": F.col("record.id"),
        "item_name": item["name"],
        "description": item["description"],
        "category_id": first_or_default(item["categories"], "id"),
        "is_taxable": item["is_taxable"] if outer else bool_text(item["is_taxable"]),
        "product_type": item["product_type"],
    }
    rows = explode_children(_objects(raw, "ITEM"), keys, item["variations"], outer=outer)
    data = F.col("child.item_variation_data")
    return rows.select(
        *keys,
        F.col("child.id").alias("variation_id"),
        data["name"].alias("variation_name"),
        data["sku"].alias("sku"),
        data["price_money"]["amount"].alias("price_amount"),
        data["price_money"]["currency"].alias("price_currency"),
    )


def flatten_inventory(raw: DataFrame, quantity_type: str = "bigint") -> DataFrame:
    """One row per variation, location and state of a count; quantity is whole unless another type is asked for."""
    typed = [(n, p, quantity_type if n == "quantity" else t) for n, p, t in INVENTORY]
    return project(explode_records(raw, "counts"), "record", typed)


def flatten_employee(raw: DataFrame) -> DataFrame:
    """One row per employee, with the first of the employee's locations."""
    records = explode_records(raw, "employees")
    typed = [safe_col(records.schema, f"record.{p}", n, t) for n, p, t in EMPLOYEE]
    return records.select(*typed, first_element(F.col("record.location_ids")).alias("location_id"))


def flatten_location(raw: DataFrame, detail: bool = False) -> DataFrame:
    """One row per location and snapshot, with the time of the snapshot. A snapshot without any keeps one row."""
    stamped = raw.select(
        safe_col(raw.schema, "ingested_at", "ingested_at", "timestamp"),
        F.explode_outer("locations").alias("record"),
    )
    typed = [safe_col(stamped.schema, f"record.{p}", n, t) for n, p, t in LOCATION]
    if detail:
        typed += [safe_col(stamped.schema, f"record.{p}", n, t) for n, p, t in LOCATION_DETAIL]
        tax = [safe_col(stamped.schema, f"record.tax_ids.{p}", p, "string") for p in ("eu_vat", "us_ein")]
        return (
            stamped.select(*typed, *tax, "ingested_at")
            .withColumn("tax_id", first_truthy(F.col("eu_vat"), F.col("us_ein")))
            .drop("eu_vat", "us_ein")
        )
    return stamped.select(*typed, "ingested_at")


def latest_location(flat: DataFrame) -> DataFrame:
    """The newest row per location by ingest time, or by update time where no snapshot has one.

    Columns without any value are dropped first, as they are in the table.
    """
    filled = drop_all_null_columns(flat, required=["location_id", "location_name"])
    newest = "ingested_at" if "ingested_at" in filled.columns else "updated_at"
    return latest_per_key(filled, ["location_id"], [newest])
