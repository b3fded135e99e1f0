"""Queries over filters, joins, aggregates, data-quality reports, keys, sorts and limits."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starledger.operators import calendar, keys, quality
from starledger.operators.reshape import explode_records
from starledger.plans import gold, report
from starledger.workload.oracle import AMOUNT, LAYERS, padded
from starledger.workload.registry import Context, query
from starledger.workload.roles import PATHS, cents, customer_id, spread

# -- filters ---------------------------------------------------------------------------------------


@query("filter_eq", "SELECT payment_id, amount FROM o_payment WHERE payment_status = 'COMPLETED'")
def filter_eq(c: Context) -> DataFrame:
    return c.silver("payment").filter(F.col("payment_status") == "COMPLETED").select("payment_id", "amount")


@query("filter_null", "SELECT order_id FROM o_header WHERE customer_id IS NULL")
def filter_null(c: Context) -> DataFrame:
    return c.silver("order_header").filter(F.col("customer_id").isNull()).select("order_id")


@query("filter_not_null", "SELECT order_id, customer_id FROM o_header WHERE customer_id IS NOT NULL")
def filter_not_null(c: Context) -> DataFrame:
    return c.silver("order_header").filter(F.col("customer_id").isNotNull()).select("order_id", "customer_id")


@query(
    "filter_compare",
    """SELECT count(*) FILTER (quantity > 0) AS above, count(*) FILTER (quantity <= 0) AS not_above,
    count(*) FILTER (quantity = 0) AS zero, count(*) FILTER (quantity <> 0) AS not_zero, count(*) AS total_rows
    FROM o_inventory""",
)
def filter_compare(c: Context) -> DataFrame:
    """A NULL quantity passes none of the comparisons."""
    q = F.col("quantity")
    return c.silver("inventory").agg(
        F.count_if(q > 0).alias("above"),
        F.count_if(q <= 0).alias("not_above"),
        F.count_if(q == 0).alias("zero"),
        F.count_if(q != 0).alias("not_zero"),
        F.count("*").alias("total_rows"),
    )


@query("filter_in", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE dayofweek(l_shipdate) IN (0, 6)")
def filter_in(c: Context) -> DataFrame:
    """Lines shipped on a weekend."""
    weekend = F.dayofweek("l_shipdate").isin(1, 7)
    return c.table("lineitem").filter(weekend).select("l_orderkey", "l_linenumber", "l_shipdate")


# -- joins -----------------------------------------------------------------------------------------


@query("dim_product_join", LAYERS["d_product"].replace("row_number() OVER (ORDER BY v.variation_id NULLS FIRST) AS product_key, ", ""))
def dim_product_join(c: Context) -> DataFrame:
    return gold.join_product(c.silver("catalog_variation"), c.silver("catalog_item"))


@query("fact_order_joins", "SELECT * EXCLUDE (order_key, date_month) FROM f_order")
def fact_order_joins(c: Context) -> DataFrame:
    dims = [c.star[n] for n in ("order_date_mapping", "dim_customer", "dim_location", "dim_date")]
    return gold.join_order(c.star["order_header"], *dims)


@query("fact_sales_joins", "SELECT * EXCLUDE (sales_key, date_month) FROM f_sales")
def fact_sales_joins(c: Context) -> DataFrame:
    line = c.star.some("order_line", [x for x in gold.SALES_COLUMNS if x in PATHS["order_line"][1]])
    return gold.join_sales(line, c.star.fact("fact_order", {"order_id", *gold.ORDER_KEYS}, exact=True), c.star["dim_product"])


@query("fact_payment_join", "SELECT * EXCLUDE (payment_key, date_month) FROM f_payment")
def fact_payment_join(c: Context) -> DataFrame:
    return gold.join_payment(c.star["payment"], c.star["fact_order"])


@query("fact_inventory_joins", "SELECT * EXCLUDE (inventory_key, date_month) FROM f_inventory")
def fact_inventory_joins(c: Context) -> DataFrame:
    dims = [c.star[n] for n in ("dim_product", "dim_location", "dim_date")]
    return gold.join_inventory(c.star["inventory"], *dims)


@query(
    "inner_reconcile_join",
    """SELECT t.tender_id, t.order_id, t.payment_id, t.amount AS tender_amount, p.amount AS payment_amount,
    t.amount - p.amount AS difference FROM o_tender t JOIN o_payment p ON t.payment_id = p.payment_id""",
)
def inner_reconcile_join(c: Context) -> DataFrame:
    tender = c.silver("order_tender").select("tender_id", "order_id", "payment_id", F.col("amount").alias("tender_amount"))
    payment = c.silver("payment").select("payment_id", F.col("amount").alias("payment_amount"))
    return tender.join(payment, "payment_id").withColumn(
        "difference", F.col("tender_amount") - F.col("payment_amount")
    )


_ANTI = "SELECT l.* FROM {0} l WHERE NOT EXISTS (SELECT 1 FROM {1} r WHERE l.{2} = r.{3})"


@query("anti_orphans", _ANTI.format("o_tender", "o_payment", "payment_id", "payment_id"))
def anti_orphans(c: Context) -> DataFrame:
    """Tenders without a payment, those without a payment id among them."""
    return quality.orphans(c.silver("order_tender"), c.silver("payment"), {"payment_id": "payment_id"})


@query("anti_orphans_variation_item", _ANTI.format("o_variation", "o_item", "item_id", "item_id"))
def anti_orphans_variation_item(c: Context) -> DataFrame:
    return quality.orphans(c.silver("catalog_variation"), c.silver("catalog_item"), {"item_id": "item_id"})


@query("anti_orphans_line_variation", _ANTI.format("o_line", "o_variation", "variation_id", "variation_id"))
def anti_orphans_line_variation(c: Context) -> DataFrame:
    return quality.orphans(c.silver("order_line"), c.silver("catalog_variation"), {"variation_id": "variation_id"})


@query("anti_orphans_inventory_variation", _ANTI.format("o_inventory", "o_variation", "variation_id", "variation_id"))
def anti_orphans_inventory_variation(c: Context) -> DataFrame:
    return quality.orphans(c.silver("inventory"), c.silver("catalog_variation"), {"variation_id": "variation_id"})


@query(
    "anti_orphans_nonnull",
    _ANTI.format("o_header", "o_customer", "customer_id", "customer_id") + " AND l.customer_id IS NOT NULL",
)
def anti_orphans_nonnull(c: Context) -> DataFrame:
    """Orders of an unknown customer; orders without a customer are left out."""
    return quality.orphans(
        c.silver("order_header"), c.silver("customer"), {"customer_id": "customer_id"}, skip_null=True
    )


@query(
    "anti_using",
    "SELECT o.business_order_id FROM o_header o WHERE o.business_order_id NOT IN "
    "(SELECT business_order_id FROM o_mapping)",
)
def anti_using(c: Context) -> DataFrame:
    """Orders whose business id has no reporting date entry; there are none."""
    header = c.silver("order_header").select("business_order_id")
    mapping = calendar.order_date_mapping(c.silver("order_header")).select("business_order_id")
    return header.join(mapping, on="business_order_id", how="left_anti")


@query(
    "orphans_distinct",
    """SELECT
    (SELECT count(*) FROM (SELECT DISTINCT payment_id FROM o_payment p WHERE NOT EXISTS
      (SELECT 1 FROM o_tender t WHERE t.payment_id = p.payment_id))) AS left_only_keys,
    (SELECT count(*) FROM (SELECT DISTINCT payment_id FROM o_tender t WHERE NOT EXISTS
      (SELECT 1 FROM o_payment p WHERE t.payment_id = p.payment_id))) AS right_only_keys""",
)
def orphans_distinct(c: Context) -> DataFrame:
    """Payments without a tender and tenders without a payment, by distinct id."""
    return quality.orphan_keys(c.silver("payment"), c.silver("order_tender"), "payment_id", "payment_id")


@query(
    "date_part_join",
    """WITH days AS (SELECT CAST(unnest(generate_series(make_date(min(year(ts)), 1, 1), make_date(max(year(ts)), 12, 31),
      INTERVAL 1 DAY)) AS DATE) AS date FROM events)
    SELECT e.event_id, d.date, CAST(year(d.date) AS INTEGER) AS year, strftime(d.date, '%B') AS month,
    'Qtr ' || quarter(d.date) AS quarter FROM events e LEFT JOIN days d ON CAST(e.ts AS DATE) = d.date""",
)
def date_part_join(c: Context) -> DataFrame:
    """Events with the calendar day they fall on."""
    events = c.table("events").select("event_id", "ts")
    joined = calendar.join_date_part(events, "ts", calendar.padded_calendar(events, "ts"))
    return joined.select("event_id", "date", "year", "month", "quarter")


# -- aggregates and reports ------------------------------------------------------------------------

_SUMS = {
    "total_quantity": "quantity",
    "gross_sales_amount": "gross_sales_amount",
    "discount_amount": "discount_amount",
    "tax_amount": "tax_amount",
    "service_charge_amount": "service_charge_amount",
    "card_surcharge_amount": "card_surcharge_amount",
    "total_amount": "total_amount",
    "variation_total_price_amount": "variation_total_price_amount",
}


def _sum(column: str) -> str:
    if column == "quantity":
        return "CAST(sum(quantity) AS DECIMAL(28,3))"
    return f"CAST(sum({column}) AS BIGINT)"


@query(
    "global_totals",
    "SELECT count(*) AS row_count, " + ", ".join(f"{_sum(v)} AS {k}" for k, v in _SUMS.items()) + " FROM o_line",
)
def global_totals(c: Context) -> DataFrame:
    return quality.totals(c.silver("order_line"), _SUMS)


@query(
    "min_max_dates",
    """SELECT CAST(min(d) AS DATE) AS first_date, CAST(max(d) AS DATE) AS last_date FROM (
    SELECT CAST(reporting_date AS TIMESTAMP) AS d FROM o_mapping UNION ALL SELECT calculated_at FROM o_inventory)""",
)
def min_max_dates(c: Context) -> DataFrame:
    mapping = calendar.order_date_mapping(c.silver("order_header")).select("reporting_date")
    return calendar.date_bounds(mapping, c.silver("inventory").select(F.to_date("calculated_at")))


@query(
    "value_counts",
    """SELECT 'objects' AS source, type AS value, row_count FROM (SELECT 'ITEM' AS type, count(*) AS row_count FROM o_item
    UNION ALL SELECT 'ITEM_VARIATION', count(*) FROM o_variation UNION ALL SELECT 'CATEGORY', count(*) FROM o_category)
    UNION ALL SELECT 'payment_status', payment_status, count(*) FROM o_payment GROUP BY payment_status
    UNION ALL SELECT 'inventory_location', location_id, count(*) FROM o_inventory GROUP BY location_id""",
)
def value_counts(c: Context) -> DataFrame:
    """Records per type, payments per status, stock counts per location; NULL is a value."""
    parts = {
        "objects": quality.value_counts(explode_records(c.narrow("catalog", "objects", ["type"]), "objects"), "record.type"),
        "payment_status": quality.value_counts(c.silver("payment"), "payment_status"),
        "inventory_location": quality.value_counts(c.silver("inventory"), "location_id"),
    }
    named = [df.select(F.lit(name).alias("source"), "value", "row_count") for name, df in parts.items()]
    return reduce(DataFrame.unionAll, named)


@query(
    "date_distribution",
    "SELECT reporting_date, count(*) AS row_count FROM o_mapping GROUP BY reporting_date ORDER BY reporting_date",
)
def date_distribution(c: Context) -> DataFrame:
    mapping = calendar.order_date_mapping(c.silver("order_header"))
    return quality.value_counts(mapping, "reporting_date", "reporting_date").orderBy("reporting_date")


@query(
    "distinct_count",
    """SELECT (SELECT count(*) FROM (SELECT DISTINCT reporting_date FROM o_mapping)) AS reporting_dates""",
)
def distinct_count(c: Context) -> DataFrame:
    """The missing date counts as one."""
    mapping = calendar.order_date_mapping(c.silver("order_header"))
    return quality.distinct_count(mapping, ["reporting_date"], "reporting_dates")


_DUPLICATES = "(SELECT count(*) FROM (SELECT 1 FROM {0} GROUP BY {1} HAVING count(*) > 1))"


@query("duplicate_keys", "SELECT " + _DUPLICATES.format("o_header", "business_order_id") + " AS duplicate_keys")
def duplicate_keys(c: Context) -> DataFrame:
    return quality.duplicate_keys(c.silver("order_header"), ["business_order_id"])


@query("duplicate_keys_null", "SELECT " + _DUPLICATES.format("o_tender", "tender_id") + " AS duplicate_keys")
def duplicate_keys_null(c: Context) -> DataFrame:
    """Orders without a tender share the missing tender id."""
    return quality.duplicate_keys(c.silver("order_tender"), ["tender_id"])


@query(
    "duplicate_keys_composite",
    "SELECT " + _DUPLICATES.format("lineitem", "l_orderkey, l_linenumber") + " AS duplicate_lines, "
    + _DUPLICATES.format("o_inventory", "variation_id, location_id") + " AS duplicate_counts",
)
def duplicate_keys_composite(c: Context) -> DataFrame:
    lines = quality.duplicate_keys(c.table("lineitem"), ["l_orderkey", "l_linenumber"], "duplicate_lines")
    counts = quality.duplicate_keys(c.silver("inventory"), ["variation_id", "location_id"], "duplicate_counts")
    return lines.withColumn("duplicate_counts", counts.scalar())


@query(
    "duplicate_key_rows",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_key_rows(c: Context) -> DataFrame:
    return quality.duplicate_key_rows(c.table("lineitem"), ["l_orderkey", "l_linenumber"])


def _null_counts(table: str, columns: list[str]) -> str:
    counts = ", ".join(f"count(*) FILTER ({x} IS NULL) AS null_{x}" for x in columns)
    return f"SELECT count(*) AS total_rows, {counts} FROM {table}"


_LINE_CHECKS = ["order_id", "order_line_id", "variation_id", "quantity"]
_TENDER_CHECKS = ["tender_id", "order_id", "payment_id", "amount"]
_SALES_CHECKS = ["order_key", "date_key", "customer_key", "product_key", "location_key"]


@query("null_counts", _null_counts("o_line", _LINE_CHECKS))
def null_counts(c: Context) -> DataFrame:
    return quality.null_counts(c.silver("order_line"), _LINE_CHECKS)


@query("null_counts_tender", _null_counts("o_tender", _TENDER_CHECKS))
def null_counts_tender(c: Context) -> DataFrame:
    return quality.null_counts(c.silver("order_tender"), _TENDER_CHECKS)


@query("null_counts_fact_sales", _null_counts("f_sales", _SALES_CHECKS))
def null_counts_fact_sales(c: Context) -> DataFrame:
    return quality.null_counts(c.star.only({"fact_sales": _SALES_CHECKS})["fact_sales"], _SALES_CHECKS)


@query("row_counts", "SELECT count(*) AS total_rows FROM lineitem")
def row_counts(c: Context) -> DataFrame:
    return quality.row_count(c.table("lineitem"))


@query("orphan_dimension_rows", "SELECT count(*) AS orphan_rows FROM d_product WHERE item_name IS NULL")
def orphan_dimension_rows(c: Context) -> DataFrame:
    product = gold.join_product(c.silver("catalog_variation"), c.silver("catalog_item"))
    return quality.missing_attribute_count(product, "item_name")


_DIM_KEYS = {
    "dim_date": ("date_key", "d_date"),
    "dim_customer": ("customer_key", "d_customer"),
    "dim_product": ("product_key", "d_product"),
    "dim_location": ("location_key", "d_location"),
}
_FACT_KEYS = {
    "fact_order": ("order_key", "f_order"),
    "fact_sales": ("sales_key", "f_sales"),
    "fact_payment": ("payment_key", "f_payment"),
    "fact_inventory": ("inventory_key", "f_inventory"),
}


def _validate_keys_sql(tables: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS total_rows,
        {_DUPLICATES.format(layer, key)} AS duplicate_keys, count(*) FILTER ({key} IS NULL) AS null_keys FROM {layer}"""
        for name, (key, layer) in tables.items()
    )


def _validate_keys(c: Context, tables: dict[str, tuple[str, str]]) -> DataFrame:
    keys = {name: {key} for name, (key, _) in tables.items() if name in _FACT_KEYS}
    if "fact_order" in keys:
        keys["fact_order"].add("order_id")  # other facts are joined by it, so that orders are built once
    star = c.star.only(keys)
    return reduce(DataFrame.unionAll, [quality.validate_key(star[name], name, key) for name, (key, _) in tables.items()])


@query("validate_dimension_key", _validate_keys_sql(_DIM_KEYS))
def validate_dimension_key(c: Context) -> DataFrame:
    return _validate_keys(c, _DIM_KEYS)


@query("validate_fact_key", _validate_keys_sql(_FACT_KEYS))
def validate_fact_key(c: Context) -> DataFrame:
    return _validate_keys(c, _FACT_KEYS)


# The thirteen pairs of the star that are checked: a fact and the dimensions it points to.
_PAIRS = [
    (fact, dim, key)
    for fact, dims in {
        "fact_order": ("dim_date", "dim_customer", "dim_location"),
        "fact_sales": ("dim_date", "dim_customer", "dim_product", "dim_location"),
        "fact_payment": ("dim_date", "dim_customer", "dim_location"),
        "fact_inventory": ("dim_date", "dim_product", "dim_location"),
    }.items()
    for dim in dims
    for key in [_DIM_KEYS[dim][0]]
]


@query(
    "validate_relationship",
    " UNION ALL ".join(
        f"""SELECT '{fact}' AS fact_name, '{dim}' AS dim_name, '{key}' AS fact_key, count(*) AS fact_rows,
        count(*) FILTER ({key} IS NULL) AS null_foreign_keys,
        count(*) FILTER (NOT EXISTS (SELECT 1 FROM {_DIM_KEYS[dim][1]} d WHERE d.{key} = f.{key})) AS orphan_records
        FROM {_FACT_KEYS[fact][1]} f"""
        for fact, dim, key in _PAIRS
    ),
)
def validate_relationship(c: Context) -> DataFrame:
    keys = {fact: {key for of, _, key in _PAIRS if of == fact} for fact in _FACT_KEYS}
    return quality.validate_relationships(c.star.only(keys), [(fact, dim, key, key) for fact, dim, key in _PAIRS])


_ONE_PAIR = f"""SELECT 'fact_sales' AS fact_name, 'dim_product' AS dim_name, 'variation_id' AS fact_key,
  count(*) AS fact_rows, count(*) FILTER (variation_id IS NULL) AS null_foreign_keys,
  count(*) FILTER (NOT EXISTS (SELECT 1 FROM d_product d WHERE d.variation_id = f.variation_id)) AS orphan_records
  FROM f_sales f"""


@query("validate_relationship_one", _ONE_PAIR)
def validate_relationship_one(c: Context) -> DataFrame:
    """One relationship, by the id that the star joins products on."""
    on = "variation_id"
    sales = c.star.only({"fact_sales": [on]})["fact_sales"]
    return quality.validate_relationship(sales, c.star["dim_product"], "fact_sales", "dim_product", on, on)


_RECONCILED = """SELECT count(*) AS matched_records, count(*) FILTER (x = y) AS amount_matches,
  count(*) FILTER (x <> y) AS amount_differences"""


@query(
    "reconcile_amounts",
    f"""{_RECONCILED} FROM (SELECT t.amount AS x, p.amount AS y FROM o_tender t
    JOIN o_payment p ON t.payment_id = p.payment_id)""",
)
def reconcile_amounts(c: Context) -> DataFrame:
    on = ("payment_id", "payment_id")
    return quality.reconcile_amounts(c.silver("order_tender"), c.silver("payment"), on, "amount", "amount")


@query(
    "reconcile_amounts_many",
    f"""{_RECONCILED} FROM (SELECT l.l_quantity AS x, e.value AS y FROM lineitem l JOIN
    (SELECT user_id, CAST(round(value) AS DOUBLE) AS value FROM events) e ON l.l_suppkey = e.user_id)""",
)
def reconcile_amounts_many(c: Context) -> DataFrame:
    """Keys with many rows on both sides: line quantities against event values of the same number."""
    events = c.table("events").select("user_id", F.round("value").alias("value"))
    return quality.reconcile_amounts(c.table("lineitem"), events, ("l_suppkey", "user_id"), "l_quantity", "value")


def _layer_total(column: str, layer: str) -> str:
    body = "count(*)" if column == "row_count" else _sum(column)
    return f"(SELECT {body} FROM {layer})"


_LAYER_COLUMNS = {"row_count": "row_count", **_SUMS}
_LAYER_PAIRS = {name: (column, column) for name, column in _SUMS.items()}


def _both_layers(c: Context, silver: str, fact: str, columns: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """A silver table and the fact made of it, with the columns that are compared."""
    return c.star.some(silver, [*columns]), c.star.only({fact: {*columns}})[fact]


@query(
    "reconcile_layers",
    "SELECT "
    + ", ".join(
        f"{_layer_total(column, 'o_line')} AS silver_{name}, {_layer_total(column, 'f_sales')} AS gold_{name}"
        for name, column in _LAYER_COLUMNS.items()
    ),
)
def reconcile_layers(c: Context) -> DataFrame:
    return quality.reconcile_layers(*_both_layers(c, "order_line", "fact_sales", _SUMS.values()), _LAYER_PAIRS)


@query(
    "reconcile_layers_diff",
    "SELECT "
    + ", ".join(
        f"CAST({_layer_total(column, 'o_line')} - {_layer_total(column, 'f_sales')} AS "
        f"{'DECIMAL(29,3)' if column == 'quantity' else 'BIGINT'}) AS {name}_difference"
        for name, column in _LAYER_COLUMNS.items()
    ),
)
def reconcile_layers_diff(c: Context) -> DataFrame:
    return quality.reconcile_layers(*_both_layers(c, "order_line", "fact_sales", _SUMS.values()), _LAYER_PAIRS, diff=True)


@query(
    "cross_one_row",
    """SELECT (SELECT count(*) FROM o_inventory) AS silver_row_count, (SELECT count(*) FROM f_inventory) AS gold_row_count,
    (SELECT CAST(sum(quantity) AS BIGINT) FROM o_inventory) AS silver_total_quantity,
    (SELECT CAST(sum(quantity) AS BIGINT) FROM f_inventory) AS gold_total_quantity""",
)
def cross_one_row(c: Context) -> DataFrame:
    """Two one-row totals side by side, for stock."""
    both = _both_layers(c, "inventory", "fact_inventory", ["quantity"])
    return quality.reconcile_layers(*both, {"total_quantity": ("quantity", "quantity")})


_FACT_LAYERS = {name: layer for name, (_, layer) in {**_DIM_KEYS, **_FACT_KEYS}.items()}


def _default_summary_sql(table: str) -> str:
    whole = table == "fact_inventory"
    sums = [f"{_sum(x).replace('DECIMAL(28,3)', 'BIGINT') if whole else _sum(x)} AS sum_{x}" for x in report.DEFAULT_SUMS.get(table, ())]
    counts = [f"count({x}) AS count_{x}" for x in report.DEFAULT_COUNTS.get(table, ())]
    return f"SELECT {', '.join(sums + counts)} FROM {_FACT_LAYERS[table]}"


def _summarised(c: Context, *names: str):
    """Layers whose facts have the columns that the default summaries of the named tables read."""
    return c.star.only({t: {*report.DEFAULT_SUMS.get(t, ()), *report.DEFAULT_COUNTS.get(t, ())} for t in names if t in _FACT_KEYS})


for _table in report.DEFAULT_SUMS:
    query(f"default_summaries_{_table}", _default_summary_sql(_table))(lambda c, t=_table: report.default_summary(_summarised(c, t), t))


def _summaries_sql(table: str) -> str:
    rows = [("sum", _sum(x), x) for x in report.DEFAULT_SUMS.get(table, ())]
    rows += [("count", f"count({x})", x) for x in report.DEFAULT_COUNTS.get(table, ())]
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{kind}_{column}' AS summary, CAST({sql} AS DECIMAL(38,3)) AS value "
        f"FROM {_FACT_LAYERS[table]}"
        for kind, sql, column in rows
    )


@query("default_summaries", " UNION ALL ".join(_summaries_sql(t) for t in report.DEFAULT_SUMS))
def default_summaries(c: Context) -> DataFrame:
    """The default summary of every column that has one, one row each."""
    parts, tables = [], _summarised(c, *report.DEFAULT_SUMS)
    for name in report.DEFAULT_SUMS:
        one = report.default_summary(tables, name)
        pairs = [
            F.struct(F.lit(x).alias("summary"), F.col(x).cast("decimal(38,3)").alias("value")) for x in one.columns
        ]
        listed = one.select(F.explode(F.array(*pairs)).alias("p"))
        parts.append(listed.select(F.lit(name).alias("table_name"), "p.summary", "p.value"))
    return reduce(DataFrame.unionAll, parts)


@query(
    "hierarchy_rollup",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'Qtr ' || quarter(o_orderdate) AS quarter,
    strftime(o_orderdate, '%B') AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
    CAST(sum({AMOUNT}) AS BIGINT) AS total_amount,
    CAST(grouping(year(o_orderdate), 'Qtr ' || quarter(o_orderdate), strftime(o_orderdate, '%B'), day(o_orderdate))
      AS BIGINT) AS level_id
    FROM orders GROUP BY ROLLUP (year(o_orderdate), 'Qtr ' || quarter(o_orderdate), strftime(o_orderdate, '%B'),
      day(o_orderdate))""",
)
def hierarchy_rollup(c: Context) -> DataFrame:
    orders = c.table("orders").select("o_orderdate", cents("o_totalprice").alias("amount"))
    return report.hierarchy_rollup(orders, "o_orderdate", "amount", "total_amount")


# -- keys, sorts, limits ---------------------------------------------------------------------------


@query(
    "surrogate_key",
    """SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)
    AS line_key, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem""",
)
def surrogate_key(c: Context) -> DataFrame:
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return keys.surrogate_key(spread(c.table("lineitem").select(*order)), order, "line_key")


@query(
    "surrogate_key_wide",
    """SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS line_key,
    l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, n AS copies
    FROM (SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)""",
)
def surrogate_key_wide(c: Context) -> DataFrame:
    """The same with a payload, which is not sorted."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    line = c.table("lineitem").select(*order)
    copies = line.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies"))
    return keys.surrogate_key(spread(line.join(copies, ["l_orderkey", "l_linenumber"])), order, "line_key")


@query(
    "surrogate_key_ties",
    """SELECT row_number() OVER (ORDER BY customer_id NULLS FIRST) AS customer_row, customer_id
    FROM (SELECT customer_id FROM o_header)""",
)
def surrogate_key_ties(c: Context) -> DataFrame:
    """Order customers: many copies of each, the missing one most of all."""
    orders = c.table("orders").select(customer_id("o_custkey").alias("customer_id"))
    return keys.surrogate_key(orders, ["customer_id"], "customer_row")


for _name, _layer in _FACT_KEYS.items():
    whole = (lambda c: c.star.entire("fact_sales")) if _name == "fact_sales" else lambda c, t=_name: c.star[t]
    query(f"star_{_name}", f"SELECT * FROM {_layer[1]}")(whole)
for _name in ("dim_customer", "dim_product", "dim_location"):
    query(f"star_{_name}", f"SELECT * FROM {_DIM_KEYS[_name][1]}")(lambda c, t=_name: c.star[t])


@query("latest_per_key", "SELECT * FROM o_location")
def latest_per_key(c: Context) -> DataFrame:
    return c.silver("location")


@query(
    "latest_per_key_events",
    """SELECT event_id, ts, user_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_key_events(c: Context) -> DataFrame:
    events = c.table("events").select("event_id", "ts", "user_id", "event_type")
    return keys.latest_per_key(events, ["user_id"], ["ts", "event_id"])


@query("drop_duplicates_on", "SELECT business_order_id, min(order_id) AS order_id FROM o_header GROUP BY 1")
def drop_duplicates_on(c: Context) -> DataFrame:
    header = c.silver("order_header").select("business_order_id", "order_id")
    return keys.first_per_key(header, ["business_order_id"], ["order_id"])


@query("order_by", "SELECT reporting_date, business_order_id FROM o_mapping ORDER BY 1 NULLS FIRST, 2")
def order_by(c: Context) -> DataFrame:
    mapping = calendar.order_date_mapping(c.silver("order_header"))
    return mapping.select("reporting_date", "business_order_id").orderBy("reporting_date", "business_order_id")


@query(
    "limit_n",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
)
def limit_n(c: Context) -> DataFrame:
    orders = c.table("orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "exists_any",
    """SELECT count(*) FILTER (quantity < 0) > 0 AS any_below_zero, count(*) FILTER (quantity > 1000) > 0 AS any_huge
    FROM o_inventory""",
)
def exists_any(c: Context) -> DataFrame:
    """Whether any row meets a condition, several conditions in one pass."""
    return c.silver("inventory").agg(
        F.coalesce(F.bool_or(F.col("quantity") < 0), F.lit(False)).alias("any_below_zero"),
        F.coalesce(F.bool_or(F.col("quantity") > 1000), F.lit(False)).alias("any_huge"),
    )


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(c: Context) -> DataFrame:
    return c.table("part").select("p_brand", "p_type").distinct()
