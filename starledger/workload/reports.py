"""Queries over measures and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starledger.functions.scalars import major_units
from starledger.operators.calendar import date_spine
from starledger.plans import measures, report
from starledger.plans.star import limited_by_stock
from starledger.workload.oracle import AMOUNT
from starledger.workload.registry import Context, query
from starledger.workload.roles import cents


def _distinct(column: str) -> str:
    return f"count(DISTINCT {column}) + max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END)"


def _distinct_where(column: str, where: str) -> str:
    return (
        f"CASE WHEN count(*) FILTER ({where}) > 0 THEN count(DISTINCT {column}) FILTER ({where}) "
        f"+ max(CASE WHEN {where} AND {column} IS NULL THEN 1 ELSE 0 END) END"
    )


# Every part in SQL: table, aggregate, and for two-step parts the inner key and aggregate.
_PARTS = {
    "sales_amount": ("f_sales", "CAST(sum(total_amount) AS BIGINT)"),
    "sales_quantity": ("f_sales", "CAST(sum(quantity) AS DECIMAL(28,3))"),
    "sales_products": ("f_sales", _distinct("product_key")),
    "sales_days": ("f_sales", _distinct("date_key")),
    "orders": ("f_order", _distinct("order_id")),
    "buyers": ("f_order", _distinct("customer_key")),
    "returning": ("f_order", "count(*) FILTER (v > 1)", "customer_key", "count(DISTINCT order_key)"),
    "customers": ("d_customer", _distinct("customer_key")),
    "payments": ("f_payment", _distinct("payment_key")),
    "payment_amount": ("f_payment", "CAST(sum(amount) AS BIGINT)"),
    "payments_completed": ("f_payment", _distinct_where("payment_key", "payment_status = 'COMPLETED'")),
    "stock": ("f_inventory", "CAST(sum(quantity) AS BIGINT)"),
    "stock_in": ("f_inventory", _distinct_where("product_key", "quantity > 0")),
    "stock_out": ("f_inventory", _distinct_where("product_key", "quantity <= 0")),
    "stock_mean": ("f_inventory", "avg(v)", "product_key", "CAST(sum(quantity) AS BIGINT)"),
    "stock_max": ("f_inventory", "max(quantity)"),
    "stock_min": ("f_inventory", "min(quantity)"),
}

_SALES = "(CAST({sales_amount} AS DOUBLE) / 100)"
_RETURNING = "coalesce({returning}, 0)"

# Every measure in SQL over its parts.
_MEASURES = {
    "total_sales": _SALES,
    "total_orders": "{orders}",
    "total_quantity_sold": "{sales_quantity}",
    "average_order_value": f"coalesce({_SALES} / nullif({{orders}}, 0), 0)",
    "total_customers": "{customers}",
    "customers_with_orders": "{buyers}",
    "repeat_customers": _RETURNING,
    "sales_per_customer": f"{_SALES} / nullif({{buyers}}, 0)",
    "total_payments": "{payments}",
    "total_payment_amount": "{payment_amount}",
    "average_payment_value": "CAST({payment_amount} AS DOUBLE) / nullif({payments}, 0)",
    "completed_payments": "{payments_completed}",
    "payment_success_rate": "CAST({payments_completed} AS DOUBLE) / nullif({payments}, 0)",
    "total_inventory_quantity": "{stock}",
    "products_in_stock": "{stock_in}",
    "out_of_stock_products": "coalesce({stock_out}, 0)",
    "average_inventory_quantity": "{stock_mean}",
    "maximum_inventory_quantity": "{stock_max}",
    "minimum_inventory_quantity": "{stock_min}",
    "items_per_order": "CAST({sales_quantity} AS DOUBLE) / nullif({orders}, 0)",
    "customer_purchase_frequency": "CAST({orders} AS DOUBLE) / nullif({buyers}, 0)",
    "sales_per_product": f"{_SALES} / nullif({{sales_products}}, 0)",
    "daily_sales": f"{_SALES} / nullif({{sales_days}}, 0)",
    "repeat_customer_rate": f"coalesce(CAST({_RETURNING} AS DOUBLE) / nullif({{buyers}}, 0), 0)",
}


# Measures that end in "+ 0" or have 0 as their other value: every member of a dimension shows one.
_NEVER_BLANK = {"average_order_value", "repeat_customers", "out_of_stock_products", "repeat_customer_rate"}


def _parts_of(names: list[str]) -> list[str]:
    return [p for p in _PARTS if any(f"{{{p}}}" in _MEASURES[n] for n in names)]


def _one_row(names: list[str], sources: dict[str, str] | None = None) -> str:
    """Measures over whole tables; ``sources`` replaces tables by filtered ones."""

    def total(part: str) -> str:
        table, outer, *inner = _PARTS[part]
        table = (sources or {}).get(table, table)
        if inner:
            table = f"(SELECT {inner[1]} AS v FROM {table} GROUP BY {inner[0]})"
        return f"(SELECT {outer} FROM {table})"

    totals = {p: total(p) for p in _parts_of(names)}
    return "SELECT " + ", ".join(f"{_MEASURES[n].format(**totals)} AS {n}" for n in names)


_KEYS = {
    "d_location": {t: ("location_key", "location_key") for t in ("f_sales", "f_order", "f_payment", "f_inventory")},
    "d_date": {t: ("date_key", "date_key") for t in ("f_sales", "f_order", "f_payment", "f_inventory")},
    "d_customer": {t: ("customer_key", "customer_key") for t in ("f_sales", "f_order", "f_payment")},
    "d_product": {"f_sales": ("variation_id", "variation_id"), "f_inventory": ("product_key", "product_key")},
}


def _grouped(names: list[str], dim: str, column: str, where: str = "") -> str:
    """Measures per value of a dimension column, each fact on its own; groups join with NULL equal to NULL."""
    parts = _parts_of(names)
    tables = []
    for part in parts:
        table, outer, *inner = _PARTS[part]
        if table == dim:
            source = f"SELECT *, {column} AS g FROM {table}"
        else:
            fact_key, dim_key = _KEYS[dim][table]
            join = "JOIN" if where else "LEFT JOIN"
            source = (
                f"SELECT f.*, d.{column} AS g FROM {table} f {join} "
                f"(SELECT {dim_key}, {column} FROM {dim} {where}) d ON f.{fact_key} = d.{dim_key}"
            )
        if inner:
            source = f"SELECT g, {inner[1]} AS v FROM ({source}) GROUP BY g, {inner[0]}"
        tables.append(f"p_{part} AS (SELECT g, {outer} AS v FROM ({source}) GROUP BY g)")
    groups = " UNION ".join(f"SELECT g FROM p_{p}" for p in parts)
    if set(names) & _NEVER_BLANK:
        groups += f" UNION SELECT {column} FROM {dim} {where}"
    joins = " ".join(f"LEFT JOIN p_{p} ON p_{p}.g IS NOT DISTINCT FROM groups.g" for p in parts)
    values = {p: f"p_{p}.v" for p in parts}
    shown = ", ".join(f"{_MEASURES[n].format(**values)} AS {n}" for n in names)
    some = " OR ".join(f"{n} IS NOT NULL" for n in names)
    return (
        f"WITH {', '.join(tables)}, groups AS ({groups}) "
        f"SELECT * FROM (SELECT groups.g AS {column}, {shown} FROM groups {joins}) WHERE {some}"
    )


# -- measures, alone and per group -----------------------------------------------------------------

for _name in _MEASURES:
    query(_name, _one_row([_name]))(lambda c, m=_name: measures.measure(c.star, m))
    if _name == "total_customers":
        query(f"{_name}_by_locality", _grouped([_name], "d_customer", "address_locality"))(
            lambda c, m=_name: measures.measure(c.star, m, ["dim_customer.address_locality"])
        )
    else:
        query(f"{_name}_by_location", _grouped([_name], "d_location", "location_name"))(
            lambda c, m=_name: measures.measure(c.star, m, ["dim_location.location_name"])
        )


_WIDE = ["total_sales", "total_orders", "repeat_customers", "total_payment_amount", "total_inventory_quantity"]


@query("measures_by_date", _grouped(_WIDE, "d_date", "date"))
def measures_by_date(c: Context) -> DataFrame:
    """Measures of four facts next to each other per date."""
    return measures.measure(c.star, _WIDE, ["dim_date.date"])


@query("repeat_customers_by_customer", _grouped(["repeat_customers"], "d_customer", "customer_name"))
def repeat_customers_by_customer(c: Context) -> DataFrame:
    """Customers without orders show 0; orders without a customer are one blank member."""
    return measures.measure(c.star, "repeat_customers", ["dim_customer.customer_name"])


@query("out_of_stock_by_item", _grouped(["out_of_stock_products"], "d_product", "item_name"))
def out_of_stock_by_item(c: Context) -> DataFrame:
    return measures.measure(c.star, "out_of_stock_products", ["dim_product.item_name"])


@query(
    "measures_by_date_and_item",
    f"""WITH s AS (SELECT d.date, p.item_name, CAST(sum(f.total_amount) AS BIGINT) AS amount FROM f_sales f
      LEFT JOIN d_date d ON f.date_key = d.date_key LEFT JOIN d_product p ON f.variation_id = p.variation_id GROUP BY ALL),
    o AS (SELECT d.date, {_distinct('order_id')} AS orders FROM f_order f LEFT JOIN d_date d ON f.date_key = d.date_key
      GROUP BY ALL)
    SELECT s.date, s.item_name, CAST(amount AS DOUBLE) / 100 AS total_sales, orders AS total_orders FROM s
    LEFT JOIN o ON s.date IS NOT DISTINCT FROM o.date WHERE amount IS NOT NULL OR orders IS NOT NULL""",
)
def measures_by_date_and_item(c: Context) -> DataFrame:
    """Orders have no path to items: the number of a date is repeated under its items."""
    return measures.measure(c.star, ["total_sales", "total_orders"], ["dim_date.date", "dim_product.item_name"])


_PAIRS = """pairs AS (SELECT l.location_name, p.item_name FROM f_sales f LEFT JOIN d_location l ON f.location_key = l.location_key
    LEFT JOIN d_product p ON f.variation_id = p.variation_id
    UNION SELECT l.location_name, p.item_name FROM f_inventory f LEFT JOIN d_location l ON f.location_key = l.location_key
    LEFT JOIN d_product p ON f.product_key = p.product_key)"""
_PAIR = ["dim_product.item_name", "dim_location.location_name"]


@query(
    "average_order_value_by_item_and_location",
    f"""WITH {_PAIRS}, s AS (SELECT l.location_name, p.item_name, CAST(sum(f.total_amount) AS BIGINT) AS amount FROM f_sales f
      LEFT JOIN d_location l ON f.location_key = l.location_key LEFT JOIN d_product p ON f.variation_id = p.variation_id
      GROUP BY ALL),
    o AS (SELECT l.location_name, {_distinct('order_id')} AS orders FROM f_order f
      LEFT JOIN d_location l ON f.location_key = l.location_key GROUP BY ALL)
    SELECT k.item_name, k.location_name, coalesce(CAST(amount AS DOUBLE) / 100 / nullif(orders, 0), 0) AS average_order_value
    FROM pairs k LEFT JOIN s ON s.location_name IS NOT DISTINCT FROM k.location_name AND s.item_name IS NOT DISTINCT FROM k.item_name
    LEFT JOIN o ON k.location_name IS NOT DISTINCT FROM o.location_name""",
)
def average_order_value_by_item_and_location(c: Context) -> DataFrame:
    """Pairs that only have stock show 0; orders, which reach locations alone, are repeated under the items."""
    return measures.measure(c.star, "average_order_value", _PAIR)


@query(
    "out_of_stock_by_item_and_location",
    f"""WITH {_PAIRS}, i AS (SELECT l.location_name, p.item_name, {_distinct_where('f.product_key', 'quantity <= 0')} AS n FROM f_inventory f
      LEFT JOIN d_location l ON f.location_key = l.location_key LEFT JOIN d_product p ON f.product_key = p.product_key GROUP BY ALL)
    SELECT k.item_name, k.location_name, coalesce(n, 0) AS out_of_stock_products FROM pairs k
    LEFT JOIN i ON i.location_name IS NOT DISTINCT FROM k.location_name AND i.item_name IS NOT DISTINCT FROM k.item_name""",
)
def out_of_stock_by_item_and_location(c: Context) -> DataFrame:
    """Pairs that only have sales show 0."""
    return measures.measure(c.star, "out_of_stock_products", _PAIR)


@query(
    "repeat_customers_by_customer_and_location",
    """WITH pairs AS (SELECT customer_name, location_name FROM f_order f LEFT JOIN d_customer USING (customer_key)
      LEFT JOIN d_location USING (location_key) UNION SELECT customer_name, location_name FROM f_sales
      LEFT JOIN d_customer USING (customer_key) LEFT JOIN d_location USING (location_key)
      UNION SELECT customer_name, location_name FROM f_payment
      LEFT JOIN d_customer USING (customer_key) LEFT JOIN d_location USING (location_key)),
    n AS (SELECT customer_name, location_name, count(*) FILTER (v > 1) AS r, count(*) AS b FROM
      (SELECT customer_name, location_name, customer_key, count(DISTINCT order_key) AS v FROM f_order
      LEFT JOIN d_customer USING (customer_key) LEFT JOIN d_location USING (location_key) GROUP BY ALL) GROUP BY ALL)
    SELECT k.customer_name, k.location_name, coalesce(r, 0) AS repeat_customers,
    coalesce(CAST(coalesce(r, 0) AS DOUBLE) / nullif(b, 0), 0) AS repeat_customer_rate FROM pairs k
    LEFT JOIN n ON n.customer_name IS NOT DISTINCT FROM k.customer_name AND n.location_name IS NOT DISTINCT FROM k.location_name""",
)
def repeat_customers_by_customer_and_location(c: Context) -> DataFrame:
    return measures.measure(
        c.star, ["repeat_customers", "repeat_customer_rate"], ["dim_customer.customer_name", "dim_location.location_name"]
    )


@query(
    "completed_payments_by_status",
    """SELECT payment_status, count(*) AS total_payments,
    (SELECT count(*) FROM f_payment WHERE payment_status = 'COMPLETED') AS completed_payments
    FROM f_payment GROUP BY payment_status""",
)
def completed_payments_by_status(c: Context) -> DataFrame:
    """The measure's own condition replaces the grouping, so each status shows the completed ones."""
    return measures.measure(c.star, ["total_payments", "completed_payments"], ["fact_payment.payment_status"])


# -- sales against an earlier period ---------------------------------------------------------------

_DAILY = """daily AS (SELECT d.date, CAST(CAST(sum(s.total_amount) AS BIGINT) AS DOUBLE) / 100 AS total_sales
  FROM f_sales s JOIN d_date d ON s.date_key = d.date_key GROUP BY d.date)"""
_GROWTH = "(coalesce(total_sales, 0) - previous_sales) / nullif(previous_sales, 0)"


def _previous(unit: str, daily: str = _DAILY, calendar: str = "SELECT date FROM d_date") -> str:
    return f"""WITH {daily}, shifted AS (
      SELECT k.date, a.total_sales, b.total_sales AS previous_sales FROM ({calendar}) k
      LEFT JOIN daily a ON a.date = k.date LEFT JOIN daily b ON b.date = CAST(k.date - INTERVAL 1 {unit} AS DATE))
    SELECT date, {{columns}} FROM shifted WHERE total_sales IS NOT NULL OR previous_sales IS NOT NULL"""


def _previous_period(c: Context, unit: str) -> DataFrame:
    return measures.previous_period(measures.daily_totals(c.star), c.star["dim_date"], unit)


@query("previous_day_sales", _previous("DAY").format(columns="total_sales, previous_sales"))
def previous_day_sales(c: Context) -> DataFrame:
    return _previous_period(c, "day").drop("growth")


@query("daily_sales_growth_pct", _previous("DAY").format(columns=f"{_GROWTH} AS daily_sales_growth_pct"))
def daily_sales_growth_pct(c: Context) -> DataFrame:
    return _previous_period(c, "day").select("date", F.col("growth").alias("daily_sales_growth_pct"))


@query("previous_month_sales", _previous("MONTH").format(columns="total_sales, previous_sales"))
def previous_month_sales(c: Context) -> DataFrame:
    return _previous_period(c, "month").drop("growth")


@query("monthly_sales_growth_pct", _previous("MONTH").format(columns=f"{_GROWTH} AS monthly_sales_growth_pct"))
def monthly_sales_growth_pct(c: Context) -> DataFrame:
    return _previous_period(c, "month").select("date", F.col("growth").alias("monthly_sales_growth_pct"))


_MONTHLY = f"""WITH {_DAILY}, months AS (SELECT DISTINCT year_month_number AS ym, year * 12 + month_number AS m FROM d_date),
  monthly AS (SELECT year(date) * 12 + month(date) AS m,
  CAST(sum(CAST(total_sales AS DECIMAL(38,2))) AS DOUBLE) AS total_sales FROM daily GROUP BY 1),
  shifted AS (SELECT months.ym, a.total_sales, b.total_sales AS previous_sales FROM months
  LEFT JOIN monthly a ON a.m = months.m LEFT JOIN monthly b ON b.m = months.m - 1)
  SELECT ym AS year_month_number, total_sales, previous_sales, {_GROWTH} AS growth FROM shifted
  WHERE total_sales IS NOT NULL OR previous_sales IS NOT NULL"""


@query("previous_month_sales_by_month", _MONTHLY)
def previous_month_sales_by_month(c: Context) -> DataFrame:
    return measures.previous_month(measures.daily_totals(c.star), c.star["dim_date"])


def _previous_total(unit: str) -> str:
    return f"""WITH {_DAILY}, sums AS (SELECT
      CAST((SELECT CAST(sum(total_amount) AS BIGINT) FROM f_sales) AS DOUBLE) / 100 AS total_sales,
      (SELECT CAST(sum(CAST(total_sales AS DECIMAL(38,2))) AS DOUBLE) FROM daily WHERE date IN
        (SELECT CAST(date - INTERVAL 1 {unit} AS DATE) FROM d_date)) AS previous_sales)
      SELECT total_sales, previous_sales, {_GROWTH} AS growth FROM sums"""


def _all_daily(c: Context) -> DataFrame:
    return measures.measure(c.star, "total_sales", ["dim_date.date"])


@query("previous_day_sales_total", _previous_total("DAY"))
def previous_day_sales_total(c: Context) -> DataFrame:
    return measures.previous_total(_all_daily(c), c.star["dim_date"], "day")


@query("previous_month_sales_total", _previous_total("MONTH"))
def previous_month_sales_total(c: Context) -> DataFrame:
    return measures.previous_total(_all_daily(c), c.star["dim_date"], "month")


_ORDER_DAYS = f"""daily AS (SELECT CAST(o_orderdate AS DATE) AS date,
  CAST(CAST(sum({AMOUNT}) AS BIGINT) AS DOUBLE) / 100 AS total_sales FROM orders GROUP BY 1)"""
_ORDER_CALENDAR = """SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE)
  AS date FROM orders"""


@query(
    "previous_month_sales_over_years",
    _previous("MONTH", _ORDER_DAYS, _ORDER_CALENDAR).format(columns=f"total_sales, previous_sales, {_GROWTH} AS growth"),
)
def previous_month_sales_over_years(c: Context) -> DataFrame:
    """Order totals by order date, over years of months of every length."""
    daily = c.table("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        major_units(F.sum(cents("o_totalprice"))).alias("total_sales")
    )
    return measures.previous_period(daily, date_spine(c.table("orders").select(F.to_date("o_orderdate"))), "month")


# -- the same under any grouping and filter --------------------------------------------------------

_SALES_KEY = {"d_product": "variation_id", "d_location": "location_key", "d_customer": "customer_key"}


def _earlier(measure: str, unit: str, groups: dict[str, str], where: str = "", more: str = "") -> str:
    """A period measure per group: ``groups`` gives ``{column: table}``, ``where`` selects dates, ``more`` other facts."""
    dates = "".join(f", {c}" for c, t in groups.items() if t == "d_date")
    names = ", ".join(groups)
    now_names, then_names = (", ".join(f"{day if t == 'd_date' else f'g_{c}'}.{c}" for c, t in groups.items()) for day in ("n", "moved"))
    others = " ".join(
        f"LEFT JOIN (SELECT {_SALES_KEY[t]}, {c} FROM {t}) g_{c} ON f.{_SALES_KEY[t]} = g_{c}.{_SALES_KEY[t]}" for c, t in groups.items() if t != "d_date"
    )
    ends = f"""UNION SELECT d.date AS at{dates.replace(', ', ', e.')} FROM (SELECT last_day(date) AS z{dates} FROM days
      WHERE date >= last_day(date) - 1 GROUP BY ALL HAVING count(*) = 2) e JOIN d_date d
      ON d.date > CAST(e.z - INTERVAL 1 MONTH AS DATE) AND d.date <= last_day(CAST(e.z - INTERVAL 1 MONTH AS DATE))"""
    day_groups = [c for c, t in groups.items() if t == "d_date"]
    now = "JOIN days n ON f.date_key = n.date_key" if where else "LEFT JOIN days n ON f.date_key = n.date_key" if day_groups else ""
    value = {"DAY": "previous_day_sales", "MONTH": "previous_month_sales"}[unit] == measure
    shown = f"previous_sales AS {measure}" if value else f"{_GROWTH} AS {measure}"
    by, comma = "GROUP BY ALL" if groups else "", "," if groups else ""
    return f"""WITH days AS (SELECT date_key, date{''.join(f', {c}' for c in day_groups if c != 'date')} FROM d_date {where}),
    moved AS (SELECT DISTINCT CAST(date - INTERVAL 1 {unit} AS DATE) AS at{dates} FROM days {ends if unit == 'MONTH' else ''}),
    stacked AS (
      SELECT {now_names}{comma} CAST(CAST(sum(f.total_amount) AS BIGINT) AS DOUBLE) / 100 AS total_sales, CAST(NULL AS DOUBLE) AS previous_sales
      FROM f_sales f {now} {others} {more} {by}
      UNION ALL SELECT {then_names}{comma} NULL, CAST(CAST(sum(f.total_amount) AS BIGINT) AS DOUBLE) / 100
      FROM f_sales f JOIN (SELECT date_key AS k, date AS a FROM d_date) t ON f.date_key = t.k JOIN moved ON moved.at = t.a {others} {more} {by}),
    folded AS (SELECT {names}{comma} max(total_sales) AS total_sales, max(previous_sales) AS previous_sales FROM stacked {by})
    SELECT * FROM (SELECT {names}{comma} {shown} FROM folded) {f'WHERE {measure} IS NOT NULL' if groups else ''}"""


_PERIODS = {
    "previous_day_sales": "DAY",
    "daily_sales_growth_pct": "DAY",
    "previous_month_sales": "MONTH",
    "monthly_sales_growth_pct": "MONTH",
}
_TABLE_OF = {"d_product": "dim_product", "d_location": "dim_location", "d_date": "dim_date", "d_customer": "dim_customer"}


def _period_query(name: str, measure: str, groups: dict[str, str], where: str = "", filters=None, more: str = "") -> None:
    by = [f"{_TABLE_OF[t]}.{c}" for c, t in groups.items()]
    query(name, _earlier(measure, _PERIODS[measure], groups, where, more))(lambda c: measures.measure(c.star, measure, by, filters and filters()))


for _name in _PERIODS:
    _period_query(f"{_name}_by_item", _name, {"item_name": "d_product"})
    _period_query(f"{_name}_by_location", _name, {"location_name": "d_location"})
    _period_query(f"{_name}_by_date_and_location", _name, {"date": "d_date", "location_name": "d_location"})
_period_query("previous_month_sales_by_customer", "previous_month_sales", {"customer_name": "d_customer"})
_period_query("previous_month_sales_by_month_and_item", "previous_month_sales", {"year_month_number": "d_date", "item_name": "d_product"})
_period_query("monthly_sales_growth_pct_by_month_and_location", "monthly_sales_growth_pct", {"year_month": "d_date", "location_name": "d_location"})
_period_query("daily_sales_growth_pct_by_weekday", "daily_sales_growth_pct", {"day_name": "d_date"})
_AUGUST = "WHERE date >= DATE '2026-08-01' AND date < DATE '2026-08-10' + 1"
_period_query(
    "previous_month_sales_by_item_in_slice", "previous_month_sales", {"item_name": "d_product"}, _AUGUST,
    lambda: report.between_dates("2026-08-01", "2026-08-10"),
)
_period_query(
    "previous_day_sales_by_locality_in_state", "previous_day_sales", {"address_locality": "d_customer"}, "",
    lambda: {"dim_location": F.col("state") == "R1"}, "JOIN d_location w ON f.location_key = w.location_key AND w.state = 'R1'",
)


# -- filters over the star -------------------------------------------------------------------------

_SLICE = ("2026-07-10", "2026-07-25")
_IN_SLICE = f"WHERE date >= DATE '{_SLICE[0]}' AND date < DATE '{_SLICE[1]}' + 1"


@query("date_slicer", _grouped(["total_sales", "total_orders"], "d_date", "date", _IN_SLICE))
def date_slicer(c: Context) -> DataFrame:
    return measures.measure(
        c.star, ["total_sales", "total_orders"], ["dim_date.date"], report.between_dates(*_SLICE)
    )


def _where_location(table: str) -> str:
    return f"(SELECT f.* FROM {table} f JOIN d_location d ON f.location_key = d.location_key AND d.state = 'R1')"


_CONTEXT = ["total_sales", "total_orders", "total_payments", "total_inventory_quantity", "total_customers"]


@query(
    "context_filter",
    _one_row(_CONTEXT, {t: _where_location(t) for t in ("f_sales", "f_order", "f_payment", "f_inventory")}),
)
def context_filter(c: Context) -> DataFrame:
    """A location filter reaches the four facts, and not the customers."""
    return measures.measure(c.star, _CONTEXT, filters={"dim_location": F.col("state") == "R1"})


_STOCKED = "(SELECT product_key FROM f_inventory WHERE quantity < -20)"


@query(
    "bidirectional_filter",
    _one_row(
        ["total_sales", "total_inventory_quantity"],
        {
            "f_sales": f"""(SELECT s.* FROM f_sales s JOIN d_product p ON s.variation_id = p.variation_id
            WHERE p.product_key IN {_STOCKED})""",
            "f_inventory": f"""(SELECT i.* FROM f_inventory i JOIN d_product p ON i.product_key = p.product_key
            WHERE i.quantity < -20)""",
        },
    ),
)
def bidirectional_filter(c: Context) -> DataFrame:
    """A condition on stock limits products, and through them sales."""
    tables, filters = limited_by_stock(c.star, F.col("quantity") < -20)
    return measures.measure(tables, ["total_sales", "total_inventory_quantity"], filters=filters, reads={"fact_inventory": ["quantity"]})


# -- report queries --------------------------------------------------------------------------------

for _page, _names in report.CARDS.items():
    query(f"kpi_cards_{_page}", _one_row(list(_names)))(lambda c, p=_page: report.cards(c.star, p))


_ALL_CARDS = [name for names in report.CARDS.values() for name in names]


@query("kpi_cards", _one_row(_ALL_CARDS))
def kpi_cards(c: Context) -> DataFrame:
    """The cards of all pages, one pass per fact."""
    return measures.measure(c.star, _ALL_CARDS)


def _ranked(sql: str, value: str, n: int = 10) -> str:
    return f"SELECT * FROM ({sql}) QUALIFY rank() OVER (ORDER BY {value} DESC NULLS LAST) <= {n}"


_ITEM_SALES = """SELECT p.item_name, CAST(CAST(sum(s.total_amount) AS BIGINT) AS DOUBLE) / 100 AS total_sales FROM f_sales s
  LEFT JOIN d_product p ON s.variation_id = p.variation_id GROUP BY p.item_name HAVING sum(s.total_amount) IS NOT NULL"""
_CUSTOMER_SALES = """SELECT d.{0}, CAST(CAST(sum(s.total_amount) AS BIGINT) AS DOUBLE) / 100 AS total_sales
  FROM f_sales s LEFT JOIN d_customer d ON s.customer_key = d.customer_key GROUP BY d.{0}
  HAVING sum(s.total_amount) IS NOT NULL"""


@query("sales_by_date", _grouped(["total_sales"], "d_date", "date"))
def sales_by_date(c: Context) -> DataFrame:
    return report.sales_by_date(c.star)


@query("quantity_by_item", _grouped(["total_quantity_sold"], "d_product", "item_name"))
def quantity_by_item(c: Context) -> DataFrame:
    return report.quantity_by_item(c.star)


@query("top10_items_by_sales", _ranked(_ITEM_SALES, "total_sales"))
def top10_items_by_sales(c: Context) -> DataFrame:
    return report.top10_items_by_sales(c.star)


@query("top10_customers_by_sales", _ranked(_CUSTOMER_SALES.format("customer_name"), "total_sales"))
def top10_customers_by_sales(c: Context) -> DataFrame:
    return report.top10_customers_by_sales(c.star)


@query("sales_by_locality", _CUSTOMER_SALES.format("address_locality"))
def sales_by_locality(c: Context) -> DataFrame:
    return report.sales_by_locality(c.star)


@query(
    "payments_by_source",
    "SELECT payment_source_type, count(*) AS total_payments FROM f_payment GROUP BY payment_source_type",
)
def payments_by_source(c: Context) -> DataFrame:
    return report.payments_by_source(c.star)


_BY_STATUS = """SELECT DISTINCT payment_status,
  CAST((SELECT CAST(sum(total_amount) AS BIGINT) FROM f_sales) AS DOUBLE) / 100 AS total_sales FROM f_payment"""


@query("sales_by_payment_status", _BY_STATUS)
def sales_by_payment_status(c: Context) -> DataFrame:
    return report.sales_by_payment_status(c.star)


@query(
    "unrelated_group",
    """SELECT address_locality, count(*) AS total_customers,
    (SELECT CAST(sum(quantity) AS BIGINT) FROM f_inventory) AS total_inventory_quantity
    FROM d_customer GROUP BY address_locality""",
)
def unrelated_group(c: Context) -> DataFrame:
    """Stock has no path to customers, so each locality shows the grand total next to its own customers."""
    return measures.measure(
        c.star, ["total_customers", "total_inventory_quantity"], ["dim_customer.address_locality"]
    )


@query("inventory_by_item", _grouped(["total_inventory_quantity"], "d_product", "item_name"))
def inventory_by_item(c: Context) -> DataFrame:
    return report.inventory_by_item(c.star)


_PRODUCT_TABLE = ["total_quantity_sold", "total_sales", "total_inventory_quantity"]


@query("product_table", _grouped(_PRODUCT_TABLE, "d_product", "item_name"))
def product_table(c: Context) -> DataFrame:
    return report.product_table(c.star)


@query("drill_across", _grouped(["total_sales", "total_inventory_quantity"], "d_product", "sku"))
def drill_across(c: Context) -> DataFrame:
    """Sales and stock side by side per stock-keeping unit, the missing one a group of its own."""
    return measures.measure(c.star, ["total_sales", "total_inventory_quantity"], ["dim_product.sku"])
