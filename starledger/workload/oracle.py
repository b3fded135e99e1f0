"""The layers stated in SQL: the rules of ``roles.py`` and of the plans, written a second time by hand.

``statement(sql)`` puts the layers a query names in front of it.
"""

from __future__ import annotations

import re

_CENTS = "CAST(round({0} * 100) AS BIGINT)"


def cents(column: str) -> str:
    return _CENTS.format(column)


def padded(prefix: str, key: str, width: int = 10) -> str:
    return f"'{prefix}' || lpad(CAST({key} AS VARCHAR), {width}, '0')"


AMOUNT = cents("o_totalprice")
GROSS = cents("l_extendedprice")
DISCOUNT = f"({GROSS} // 100) * CAST(round(l_discount * 100) AS BIGINT)"
TAX = f"({GROSS} // 100) * CAST(round(l_tax * 100) AS BIGINT)"
CUSTOMER_ID = (
    "CASE WHEN {0} % 10 = 0 THEN NULL WHEN {0} % 33 = 0 THEN "
    + padded("X", "{0}")
    + " ELSE "
    + padded("C", "{0}")
    + " END"
)
BUSINESS_ID = f"""CASE WHEN o_orderkey % 101 = 7 THEN 'ORD-WALKIN'
  WHEN o_orderkey % 53 = 2 THEN {padded('ORD-', '(o_orderkey - 1)', 8)}
  ELSE {padded('ORD-', 'o_orderkey', 8)} END"""
LINE_VARIATION = (
    f"CASE WHEN l_partkey % 41 = 0 THEN {padded('VX', 'l_partkey')} ELSE {padded('V', 'l_partkey')} END"
)
LINE_ID = "concat_ws('-', l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'))"
LINE_ORDER = f"CASE WHEN l_orderkey % 211 = 0 THEN {padded('Z', 'l_orderkey')} ELSE {padded('S', 'l_orderkey')} END"
EMPTY_LINE = ", ".join(
    f"CAST(NULL AS {t}) AS {n}"
    for n, t in [
        ("order_line_id", "VARCHAR"),
        ("variation_id", "VARCHAR"),
        ("catalog_version", "BIGINT"),
        ("item_name", "VARCHAR"),
        ("variation_name", "VARCHAR"),
        ("item_type", "VARCHAR"),
        ("quantity", "DECIMAL(18,3)"),
        ("unit_price", "BIGINT"),
        ("currency", "VARCHAR"),
        ("gross_sales_amount", "BIGINT"),
        ("discount_amount", "BIGINT"),
        ("tax_amount", "BIGINT"),
        ("service_charge_amount", "BIGINT"),
        ("card_surcharge_amount", "BIGINT"),
        ("total_amount", "BIGINT"),
        ("variation_total_price_amount", "BIGINT"),
    ]
)
_LINE_PARENT = f"""{LINE_ORDER} AS order_id, {padded('ORD-', 'l_orderkey', 8)} AS business_order_id,
  {padded('L', '(l_suppkey % 27)', 4)} AS location_id"""

LAYERS = {
    "o_header": f"""SELECT {padded('S', 'o_orderkey')} AS order_id, {BUSINESS_ID} AS business_order_id,
  {padded('L', '(o_custkey % 27)', 4)} AS location_id, {CUSTOMER_ID.format('o_custkey')} AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'OPEN' ELSE 'CANCELED' END AS order_state,
  o_orderkey % 7 AS order_version,
  o_orderdate AS created_at, o_orderdate + INTERVAL 1 DAY AS updated_at,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + INTERVAL 2 DAY END AS closed_at,
  {AMOUNT} AS total_amount, 'USD' AS currency,
  {AMOUNT} * 8 // 100 AS total_tax_amount, {AMOUNT} * 5 // 100 AS total_discount_amount,
  CASE WHEN o_orderpriority = '1-URGENT' THEN {AMOUNT} * 10 // 100 END AS total_tip_amount,
  CAST(0 AS BIGINT) AS total_service_charge_amount, CASE WHEN o_orderkey % 5 = 0 THEN {AMOUNT} * 2 // 100 END AS total_card_surcharge_amount,
  {AMOUNT} - {AMOUNT} * 5 // 100 AS net_total_amount,
  {AMOUNT} * 8 // 100 AS net_tax_amount, {AMOUNT} * 5 // 100 AS net_discount_amount,
  CASE WHEN o_orderpriority = '1-URGENT' THEN {AMOUNT} * 10 // 100 END AS net_tip_amount,
  CAST(0 AS BIGINT) AS net_service_charge_amount, CASE WHEN o_orderkey % 10 = 0 THEN {AMOUNT} * 2 // 100 END AS net_card_surcharge_amount,
  CASE WHEN o_orderstatus = 'O' THEN {AMOUNT} ELSE CAST(0 AS BIGINT) END AS net_amount_due,
  o_orderpriority AS source_name
  FROM orders""",
    "o_line": f"""SELECT {_LINE_PARENT}, {LINE_ID} AS order_line_id, {LINE_VARIATION} AS variation_id,
  l_partkey % 5 AS catalog_version, 'Line ' || l_returnflag AS item_name, 'Status ' || l_linestatus AS variation_name,
  'ITEM' AS item_type, CAST(CAST(l_quantity AS INTEGER) + 0.25 AS DECIMAL(18,3)) AS quantity,
  CAST(floor({GROSS} / l_quantity) AS BIGINT) AS unit_price, 'USD' AS currency,
  {GROSS} AS gross_sales_amount, {DISCOUNT} AS discount_amount, {TAX} AS tax_amount,
  CAST(0 AS BIGINT) AS service_charge_amount, CASE WHEN l_partkey % 4 = 0 THEN {GROSS} // 100 END AS card_surcharge_amount,
  {GROSS} - {DISCOUNT} + {TAX} AS total_amount, {GROSS} AS variation_total_price_amount
  FROM lineitem
  UNION ALL
  SELECT {_LINE_PARENT}, {LINE_ID} || '-free', {LINE_VARIATION}, NULL, NULL, NULL, 'CUSTOM_AMOUNT',
  CAST(1 AS DECIMAL(18,3)), NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(0 AS BIGINT), NULL
  FROM lineitem WHERE l_discount >= 0.09
  UNION ALL
  SELECT {_LINE_PARENT}, {EMPTY_LINE} FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 97 = 0
  UNION ALL
  SELECT {_LINE_PARENT}, {EMPTY_LINE} FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 89 = 0""",
    "o_tender_parent": f"""SELECT *, {AMOUNT} AS amt, {padded('S', 'o_orderkey')} AS order_id,
  {BUSINESS_ID} AS business_order_id, {padded('L', '(o_custkey % 27)', 4)} AS order_location_id,
  (o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0) AS has_tender
  FROM orders""",
    "o_tender_pair": f"""SELECT *, 1 AS number,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN {padded('PX', 'o_orderkey')}
    ELSE {padded('P', 'o_orderkey')} END AS paid_to,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN amt + 1 ELSE amt END AS paid
  FROM o_tender_parent WHERE has_tender
  UNION ALL
  SELECT *, 2, {padded('P', '(o_orderkey + 1)')}, amt * 10 // 100
  FROM o_tender_parent WHERE has_tender AND o_totalprice > 400000""",
    "o_tender": f"""SELECT order_id, business_order_id, order_location_id,
  {padded('T', 'o_orderkey')} || '-' || number AS tender_id, paid_to AS payment_id,
  {padded('X', 'o_custkey')} AS transaction_id, o_orderdate AS created_at, paid AS amount, 'USD' AS currency,
  CASE WHEN o_orderstatus = 'F' THEN 'CARD' ELSE 'CASH' END AS tender_type,
  o_orderpriority AS payment_source, o_orderstatus AS tender_status,
  CASE WHEN o_orderstatus = 'F' THEN 'VISA' END AS card_brand,
  CASE WHEN o_orderstatus = 'F' THEN 'CREDIT' END AS card_type,
  CASE WHEN o_orderstatus = 'F' THEN lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS card_last_4,
  CASE WHEN o_orderstatus = 'F' THEN 'KEYED' END AS card_entry_method,
  CASE WHEN o_orderstatus = 'F' THEN 'CAPTURED' END AS card_status,
  CASE WHEN o_orderstatus <> 'F' THEN amt + 500 END AS cash_buyer_tendered_amount,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(500 AS BIGINT) END AS cash_change_back_amount
  FROM o_tender_pair
  UNION ALL
  SELECT order_id, business_order_id, order_location_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM o_tender_parent WHERE NOT has_tender""",
    "o_payment_detail": f"""SELECT {padded('P', 'o_orderkey')} AS payment_id,
  CASE WHEN o_orderkey % 31 = 0 THEN {padded('Z', 'o_orderkey')} ELSE {padded('S', 'o_orderkey')} END AS order_id,
  {CUSTOMER_ID.format('o_custkey')} AS customer_id, {padded('L', '(o_custkey % 27)', 4)} AS location_id,
  {AMOUNT} AS amount, 'USD' AS currency, {AMOUNT} AS total_amount, 'USD' AS total_currency,
  CASE o_orderpriority WHEN '3-MEDIUM' THEN 'APPROVED' WHEN '4-NOT SPECIFIED' THEN 'FAILED' ELSE 'COMPLETED' END
    AS payment_status,
  CASE o_orderstatus WHEN 'F' THEN 'CARD' WHEN 'O' THEN 'CASH' ELSE 'EXTERNAL' END AS payment_source_type,
  o_orderdate AS created_at, o_orderdate + INTERVAL 1 DAY AS updated_at,
  substr(lpad(CAST(o_orderkey AS VARCHAR), 10, '0'), 7, 4) AS receipt_number,
  CASE WHEN o_orderstatus = 'P' THEN 'partner' END AS external_source,
  CASE WHEN o_orderstatus = 'P' THEN 'OTHER' END AS external_type,
  CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_custkey % 3 = 0 THEN 'VISA' ELSE 'MASTERCARD' END END AS card_brand,
  CASE WHEN o_orderstatus = 'F' THEN 'CREDIT' END AS card_type,
  CASE WHEN o_orderstatus = 'F' THEN lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS card_last_4,
  CASE WHEN o_orderstatus = 'F' THEN 'KEYED' END AS card_entry_method,
  CASE WHEN o_orderstatus = 'F' THEN 'CAPTURED' END AS card_status,
  CASE WHEN o_orderstatus = 'F' THEN 'AVS_ACCEPTED' END AS avs_status,
  CASE WHEN o_orderstatus = 'F' THEN 'CVV_ACCEPTED' END AS cvv_status,
  CASE WHEN o_orderstatus = 'O' THEN {AMOUNT} + 500 END AS cash_buyer_supplied_amount,
  CASE WHEN o_orderstatus = 'O' THEN CAST(500 AS BIGINT) END AS cash_change_back_amount,
  CASE WHEN o_totalprice > 300000 THEN 'MODERATE' ELSE 'NORMAL' END AS risk_level,
  'app-1' AS application_id, 'REGISTER' AS application_product, {padded('tok', 'o_custkey', 6)} AS version_token,
  CASE WHEN o_orderkey % 3 = 0 THEN {padded('https://receipts.example/', 'o_orderkey')} END AS receipt_url, 'CANCEL' AS delay_action, 'PT168H' AS delay_duration,
  o_orderdate + INTERVAL 7 DAY AS delayed_until,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN {AMOUNT} END AS approved_amount,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'USD' END AS approved_currency,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 12 + 1 AS INTEGER) END AS card_exp_month,
  CASE WHEN o_orderstatus = 'F' THEN 2030 END AS card_exp_year,
  CASE WHEN o_orderstatus = 'F' THEN {padded('fp', 'o_custkey')} END AS card_fingerprint,
  CASE WHEN o_orderstatus = 'F' THEN 'NOT_PREPAID' END AS card_prepaid_type,
  CASE WHEN o_orderstatus = 'F' THEN lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') END AS auth_result_code,
  CASE WHEN o_orderstatus = 'F' THEN 'RESTAURANT' END AS statement_description,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS authorized_at,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS captured_at,
  CASE WHEN o_orderstatus = 'O' THEN 'USD' END AS cash_buyer_supplied_currency
  FROM orders""",
    "o_payment": """SELECT * EXCLUDE (receipt_url, delay_action, delay_duration, delayed_until, approved_amount,
  approved_currency, card_exp_month, card_exp_year, card_fingerprint, card_prepaid_type, auth_result_code,
  statement_description, authorized_at, captured_at, cash_buyer_supplied_currency) FROM o_payment_detail""",
    "o_customer": f"""SELECT {padded('C', 'c_custkey')} AS customer_id, {padded('R', 'c_custkey')} AS reference_id,
  CASE WHEN c_custkey % 20 <> 0 THEN {padded('Given', '(c_custkey % 40)', 2)} END AS given_name,
  CASE WHEN c_custkey % 20 <> 0 AND c_custkey % 15 <> 0 THEN {padded('Family', '(c_custkey % 17)', 2)} END
    AS family_name,
  c_mktsegment || '@example.com' AS email_address, {padded('+1', 'c_custkey')} AS phone_number,
  TIMESTAMP '2020-01-02 03:04:05' AS created_at,
  CASE WHEN c_custkey % 6 <> 0 THEN TIMESTAMP '2021-02-03 04:05:06.789' END AS updated_at,
  'DIRECTORY' AS creation_source, 'D' || (c_nationkey % 5) AS address_district,
  CASE WHEN c_nationkey < 24 THEN {padded('City ', 'c_nationkey', 2)} END AS address_locality,
  lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS address_postal_code, 'US' AS address_country,
  c_acctbal < 0 AS email_unsubscribed,
  CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS segment_id, c_custkey % 4 AS version
  FROM customer""",
    "o_item": """SELECT DISTINCT 'I-' || p_brand AS item_id, 'Item ' || right(p_brand, 1) AS item_name,
  CASE WHEN p_brand <> 'Brand#4' THEN 'About ' || p_brand END AS description, 'REGULAR' AS product_type, FALSE AS is_archived,
  p_brand <> 'Brand#5' AS is_taxable, p_brand = 'Brand#3' AS is_deleted,
  TIMESTAMP '2022-01-01' AS created_at, TIMESTAMP '2022-06-01' AS updated_at,
  CAST(length(p_brand) AS BIGINT) AS version
  FROM part WHERE p_brand <> 'Brand#7'""",
    "o_variation": f"""SELECT {padded('V', 'p_partkey')} AS variation_id, 'I-' || p_brand AS item_id,
  p_name AS variation_name, CASE WHEN p_partkey % 37 <> 0 THEN {padded('SKU', 'p_partkey', 6)} END AS sku,
  CAST(p_size AS BIGINT) AS ordinal, CASE WHEN p_size % 10 <> 0 THEN {cents('p_retailprice')} END AS price_amount,
  CASE WHEN p_size % 10 <> 0 THEN 'USD' END AS currency,
  CASE WHEN p_size % 10 = 0 THEN 'VARIABLE_PRICING' ELSE 'FIXED_PRICING' END AS pricing_type,
  p_partkey % 25 <> 0 AS sellable, TRUE AS stockable, p_partkey % 50 = 0 AS is_deleted,
  TRUE AS present_at_all_locations, TIMESTAMP '2022-01-01' AS created_at, TIMESTAMP '2022-06-01' AS updated_at,
  p_partkey % 3 AS version
  FROM part""",
    "o_category": """SELECT DISTINCT 'G-' || p_type AS category_id, 'CATEGORY' AS type,
  CAST(length(p_type) AS BIGINT) AS version, FALSE AS is_deleted, TRUE AS present_at_all_locations,
  TIMESTAMP '2022-01-01' AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at,
  upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS category_name, p_type = 'SMALL' AS is_top_level,
  TRUE AS online_visibility, 'REGULAR_CATEGORY' AS category_type,
  CASE WHEN p_type <> 'SMALL' THEN 'G-SMALL' END AS parent_category_id
  FROM part""",
    "o_nested": f"""SELECT {padded('N', 'p_partkey')} AS item_id, p_name AS item_name,
  CASE WHEN p_size % 6 <> 0 THEN p_name || ' ' || p_type END AS description,
  CASE WHEN p_size % 4 = 0 OR p_size % 5 = 0 THEN '' ELSE 'G-' || p_type END AS category_id,
  CASE WHEN p_size % 8 <> 0 THEN p_size > 25 END AS is_taxable, 'REGULAR' AS product_type,
  CASE WHEN n = 1 THEN {padded('V', 'p_partkey')} WHEN n = 2 THEN {padded('VL', 'p_partkey')} END AS variation_id,
  CASE WHEN n > 0 THEN p_name END AS variation_name,
  CASE WHEN n > 0 AND p_partkey % 37 <> 0 THEN {padded('SKU', 'p_partkey', 6)} END AS sku,
  CASE WHEN n > 0 AND p_size % 10 <> 0 THEN {cents('p_retailprice')} END AS price_amount,
  CASE WHEN n > 0 AND p_size % 10 <> 0 THEN 'USD' END AS price_currency
  FROM (SELECT *, 0 AS n FROM part WHERE p_size % 7 = 0
        UNION ALL SELECT *, 1 FROM part WHERE p_size % 7 <> 0
        UNION ALL SELECT *, 2 FROM part WHERE p_size % 7 <> 0 AND p_size % 3 = 0)""",
    "o_inventory": f"""SELECT {LINE_VARIATION} AS variation_id, 'ITEM_VARIATION' AS catalog_object_type,
  CASE l_returnflag WHEN 'N' THEN 'IN_STOCK' WHEN 'A' THEN 'SOLD' ELSE 'WASTE' END AS inventory_state,
  CASE WHEN l_suppkey % 20 <> 0 THEN {padded('L', '(l_suppkey % 27)', 4)} END AS location_id,
  CASE WHEN l_orderkey % 61 <> 0 THEN CAST(CAST(l_quantity AS INTEGER) - 25 AS BIGINT) END AS quantity,
  CASE WHEN l_orderkey % 67 <> 0 THEN l_shipdate END AS calculated_at
  FROM lineitem""",
    "o_employee": f"""SELECT {padded('E', 's_suppkey')} AS employee_id, s_name AS first_name,
  CASE WHEN s_suppkey % 4 <> 0 THEN 'Last' || (s_suppkey % 9) END AS last_name,
  s_name || '@example.com' AS email, CASE WHEN s_suppkey % 2 = 0 THEN {padded('+2', 's_suppkey')} END AS phone_number,
  CASE WHEN s_acctbal > 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS employee_status,
  TIMESTAMP '2020-05-06 07:08:09' AS created_at, TIMESTAMP '2020-05-07 07:08:09' AS updated_at,
  CASE WHEN s_suppkey % 8 <> 0 THEN {padded('L', '(s_nationkey % 27)', 4)} END AS location_id
  FROM supplier""",
    "o_location_detail": f"""SELECT {padded('L', 'n_nationkey', 4)} AS location_id,
  upper(left(n_name, 1)) || lower(substr(n_name, 2)) || ' v' || v AS location_name, 'Restaurant' AS business_name,
  CASE WHEN n_nationkey % 6 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS location_status, 'PHYSICAL' AS location_type,
  {padded('Street ', 'n_nationkey', 2)} AS address_line_1, CAST(NULL AS VARCHAR) AS address_line_2, n_name AS city,
  'R' || n_regionkey AS state, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS postal_code, 'US' AS country,
  'UTC' AS timezone, 'USD' AS currency, 'en-US' AS language_code, TIMESTAMP '2019-01-01' AS created_at,
  CAST(NULL AS TIMESTAMP) AS updated_at,
  CASE WHEN v = 1 THEN TIMESTAMP '2026-08-20' WHEN n_nationkey % 4 <> 0 THEN TIMESTAMP '2026-08-21' END AS ingested_at,
  {padded('M', 'n_regionkey', 3)} AS merchant_id, CASE WHEN n_nationkey % 2 = 0 THEN {padded('+3', 'n_nationkey')} END AS phone_number,
  CASE WHEN n_nationkey % 3 = 0 THEN 'https://' || lower(n_name) || '.example' END AS website_url,
  CASE WHEN n_nationkey % 4 = 0 THEN 'In ' || n_name END AS description,
  CASE WHEN n_nationkey % 5 <> 0 THEN 'US' END AS business_country,
  CAST(n_nationkey + 0.5 AS DOUBLE) AS latitude, CAST(n_regionkey - 0.25 AS DOUBLE) AS longitude,
  {padded('58', 'n_regionkey', 2)} AS mcc,
  CASE WHEN n_nationkey % 2 = 0 THEN {padded('T', 'n_nationkey', 3)}
    WHEN n_nationkey % 3 = 0 THEN {padded('VAT', 'n_nationkey', 3)} END AS tax_id
  FROM nation, (VALUES (1), (2)) AS versions(v)""",
    "o_location_all": """SELECT location_id, location_name, business_name, location_status, location_type, address_line_1,
  address_line_2, city, state, postal_code, country, timezone, currency, language_code, created_at, updated_at,
  ingested_at FROM o_location_detail""",
    "o_location": """SELECT location_id, location_name, business_name, location_status, location_type, address_line_1,
  city, state, postal_code, country, timezone, currency, language_code, created_at, ingested_at FROM o_location_all
  QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY ingested_at DESC NULLS LAST) = 1""",
    "o_mapping": """SELECT business_order_id, min(order_id) AS order_id,
  DATE '2026-07-01' + CAST((((TRY_CAST(regexp_extract(business_order_id, '(\\d+)$', 1) AS INTEGER) - 1) % 50) + 50) % 50
    AS INTEGER) AS reporting_date
  FROM o_header GROUP BY business_order_id""",
    "g_dates": """SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS date FROM (
  SELECT CAST(reporting_date AS TIMESTAMP) AS d FROM o_mapping
  UNION ALL SELECT date_trunc('day', calculated_at) FROM o_inventory)""",
    "d_date": """SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date,
  CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter_number, 'Q' || quarter(date) AS quarter,
  CAST(month(date) AS INTEGER) AS month_number, strftime(date, '%B') AS month_name,
  strftime(date, '%b') AS month_short_name, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
  CAST(day(date) AS INTEGER) AS day_of_month, strftime(date, '%A') AS day_name, strftime(date, '%a') AS day_short_name,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week_number, dayofweek(date) IN (0, 6) AS is_weekend,
  strftime(date, '%Y-%m') AS year_month, CAST(year(date) * 100 + month(date) AS INTEGER) AS year_month_number
  FROM g_dates""",
    "d_customer": """SELECT row_number() OVER (ORDER BY customer_id NULLS FIRST) AS customer_key, customer_id, reference_id,
  trim(concat_ws(' ', given_name, family_name)) AS customer_name, given_name, family_name, email_address, phone_number,
  created_at, updated_at, address_district, address_locality, address_postal_code, address_country FROM o_customer""",
    "d_product": """SELECT row_number() OVER (ORDER BY v.variation_id NULLS FIRST) AS product_key, v.variation_id,
  v.item_id, i.item_name, i.description, i.product_type, v.variation_name, v.sku, v.ordinal, v.price_amount, v.currency,
  v.pricing_type, v.sellable, v.stockable, i.is_archived, i.is_taxable, v.is_deleted AS is_variation_deleted,
  i.is_deleted AS is_item_deleted, v.present_at_all_locations, v.created_at, v.updated_at, v.version
  FROM o_variation v LEFT JOIN o_item i ON v.item_id = i.item_id""",
    "d_location": "SELECT row_number() OVER (ORDER BY location_id NULLS FIRST) AS location_key, * FROM o_location",
    "f_order": """SELECT row_number() OVER (ORDER BY o.order_id NULLS FIRST) AS order_key, o.order_id, o.business_order_id,
  d.date_key, CAST(d.date_key // 100 AS INTEGER) AS date_month, c.customer_key, l.location_key, o.order_state, o.order_version, o.currency, o.created_at, o.updated_at,
  o.closed_at, o.total_amount, o.total_tax_amount, o.total_discount_amount, o.total_tip_amount,
  o.total_service_charge_amount, o.total_card_surcharge_amount, o.net_total_amount, o.net_tax_amount,
  o.net_discount_amount, o.net_tip_amount, o.net_service_charge_amount, o.net_card_surcharge_amount, o.net_amount_due
  FROM o_header o LEFT JOIN o_mapping m ON o.order_id = m.order_id
  LEFT JOIN d_customer c ON o.customer_id = c.customer_id LEFT JOIN d_location l ON o.location_id = l.location_id
  LEFT JOIN d_date d ON m.reporting_date = d.date""",
    "f_sales": """SELECT row_number() OVER (ORDER BY ol.order_id NULLS FIRST, ol.order_line_id NULLS FIRST) AS sales_key,
  fo.order_key, fo.date_key, fo.date_month, fo.customer_key, p.product_key, fo.location_key, ol.order_id, ol.business_order_id,
  ol.order_line_id, ol.variation_id, ol.item_name, ol.variation_name, ol.item_type, ol.quantity, ol.unit_price,
  ol.gross_sales_amount, ol.discount_amount, ol.tax_amount, ol.service_charge_amount, ol.card_surcharge_amount,
  ol.total_amount, ol.variation_total_price_amount, ol.currency
  FROM o_line ol LEFT JOIN f_order fo ON ol.order_id = fo.order_id
  LEFT JOIN d_product p ON ol.variation_id = p.variation_id""",
    "f_payment": """SELECT row_number() OVER (ORDER BY p.payment_id NULLS FIRST) AS payment_key, fo.order_key, fo.date_key, fo.date_month,
  fo.customer_key, fo.location_key, p.payment_id, p.order_id, p.customer_id, p.amount, p.currency, p.total_amount,
  p.total_currency, p.payment_status, p.payment_source_type, p.created_at, p.updated_at, p.receipt_number,
  p.external_source, p.external_type, p.card_brand, p.card_type, p.card_last_4, p.card_entry_method, p.card_status,
  p.avs_status, p.cvv_status, p.cash_buyer_supplied_amount, p.cash_change_back_amount, p.risk_level, p.application_id,
  p.application_product, p.version_token
  FROM o_payment p LEFT JOIN f_order fo ON p.order_id = fo.order_id""",
    "f_inventory": """SELECT row_number() OVER (ORDER BY i.variation_id NULLS FIRST, i.location_id NULLS FIRST,
    CAST(i.calculated_at AS DATE) NULLS FIRST, i.inventory_state NULLS FIRST, i.quantity NULLS FIRST,
    i.calculated_at NULLS FIRST) AS inventory_key,
  d.date_key, CAST(d.date_key // 100 AS INTEGER) AS date_month, p.product_key, l.location_key, i.variation_id, i.location_id, i.catalog_object_type, i.inventory_state,
  i.quantity, CAST(i.calculated_at AS DATE) AS inventory_date, i.calculated_at
  FROM o_inventory i LEFT JOIN d_product p ON i.variation_id = p.variation_id
  LEFT JOIN d_location l ON i.location_id = l.location_id LEFT JOIN d_date d ON CAST(i.calculated_at AS DATE) = d.date""",
}


def _named(sql: str) -> set[str]:
    return {name for name in LAYERS if re.search(rf"\b{name}\b", sql)}


def statement(sql: str) -> str:
    """``sql`` with the layers it uses, and those they use, as common table expressions."""
    needed, open_names = set(), _named(sql)
    while open_names:
        name = open_names.pop()
        needed.add(name)
        open_names |= _named(LAYERS[name]) - needed
    if not needed:
        return sql
    tables = ",\n".join(f"{name} AS (\n{body})" for name, body in LAYERS.items() if name in needed)
    joined = sql.lstrip()
    if joined.upper().startswith("WITH "):
        return f"WITH {tables},\n{joined[5:]}"
    return f"WITH {tables}\n{joined}"
