"""Queries over scalar functions and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starledger.functions import scalars
from starledger.operators import calendar
from starledger.plans import gold
from starledger.workload.oracle import AMOUNT
from starledger.workload.registry import Context, query
from starledger.workload.roles import cents, every


@query(
    "cast_lenient",
    """SELECT event_id, CASE WHEN event_id % 4 = 1 THEN NULL ELSE event_id END AS as_long,
    CASE WHEN event_id % 4 = 1 THEN NULL ELSE CAST(event_id % 1000 AS INTEGER) END AS as_int,
    CASE WHEN event_id % 4 = 1 THEN NULL WHEN event_id % 4 = 2 THEN CAST(event_id + 0.75 AS DECIMAL(18,3))
      ELSE CAST(event_id AS DECIMAL(18,3)) END AS as_decimal,
    CASE WHEN event_id % 4 = 3 THEN NULL ELSE CAST(ts AS DATE) END AS as_date,
    CASE WHEN event_id % 4 = 3 THEN NULL ELSE ts END AS as_timestamp FROM events""",
)
def cast_lenient(c: Context) -> DataFrame:
    """Numbers and dates as text, some of it with a fraction, some unreadable."""

    def text(of):
        kind = F.col("event_id") % 4
        number = of.cast("string")
        return F.when(kind == 1, "n/a").when(kind == 2, F.concat(number, F.lit(".75"))).otherwise(number)

    moment = F.when(every("event_id", 4, 3), "never").otherwise(F.col("ts").cast("string"))
    return c.table("events").select(
        "event_id",
        scalars.lenient_cast(text(F.col("event_id")), "bigint").alias("as_long"),
        scalars.lenient_cast(text(F.col("event_id") % 1000), "int").alias("as_int"),
        scalars.lenient_cast(text(F.col("event_id")), "decimal(18,3)").alias("as_decimal"),
        scalars.lenient_cast(moment, "date").alias("as_date"),
        scalars.lenient_cast(moment, "timestamp").alias("as_timestamp"),
    )


@query(
    "parse_timestamp",
    """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('millisecond', ts) END AS at FROM events""",
)
def parse_timestamp(c: Context) -> DataFrame:
    """ISO text with milliseconds, some of it unreadable."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = F.when(every("event_id", 5), "soon").otherwise(iso)
    return c.table("events").select("event_id", scalars.parse_timestamp(text).alias("at"))


@query("to_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def to_date(c: Context) -> DataFrame:
    return c.table("events").select("event_id", F.to_date("ts").alias("day"))


@query("order_date_mapping", "SELECT * FROM o_mapping")
def order_date_mapping(c: Context) -> DataFrame:
    return gold.build_date_mapping(calendar.order_date_mapping(c.silver("order_header")))


@query("customer_name", "SELECT customer_id, trim(concat_ws(' ', given_name, family_name)) AS customer_name FROM o_customer")
def customer_name(c: Context) -> DataFrame:
    name = scalars.full_name(F.col("given_name"), F.col("family_name"))
    return c.silver("customer").select("customer_id", name.alias("customer_name"))


@query(
    "date_spine",
    "SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders",
)
def date_spine(c: Context) -> DataFrame:
    return calendar.date_spine(c.table("orders").select(F.to_date("o_orderdate")))


@query("dim_date", "SELECT * FROM d_date")
def dim_date(c: Context) -> DataFrame:
    mapping = calendar.order_date_mapping(c.silver("order_header"))
    return gold.build_dim_date(mapping, c.silver("inventory"))


@query(
    "padded_calendar",
    """WITH days AS (SELECT CAST(unnest(generate_series(make_date(min(year(l_shipdate)), 1, 1),
      make_date(max(year(l_shipdate)), 12, 31), INTERVAL 1 DAY)) AS DATE) AS date FROM lineitem)
    SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_no,
    strftime(date, '%B') AS month, CAST(quarter(date) AS INTEGER) AS quarter_no, 'Qtr ' || quarter(date) AS quarter,
    CAST(day(date) AS INTEGER) AS day FROM days""",
)
def padded_calendar(c: Context) -> DataFrame:
    return calendar.padded_calendar(c.table("lineitem"), "l_shipdate")


@query("money_major_units", f"SELECT o_orderkey, {AMOUNT} / 100 AS price FROM orders")
def money_major_units(c: Context) -> DataFrame:
    return c.table("orders").select("o_orderkey", scalars.major_units(cents("o_totalprice")).alias("price"))


@query(
    "subtract",
    """SELECT order_id, total_amount - total_tip_amount AS without_tip, total_amount - net_total_amount AS discount
    FROM o_header""",
)
def subtract(c: Context) -> DataFrame:
    """A difference with a NULL is NULL."""
    return c.silver("order_header").select(
        "order_id",
        (F.col("total_amount") - F.col("total_tip_amount")).alias("without_tip"),
        (F.col("total_amount") - F.col("net_total_amount")).alias("discount"),
    )


@query(
    "null_literal",
    """SELECT r_regionkey, CAST(NULL AS VARCHAR) AS text, CAST(NULL AS BIGINT) AS number, CAST(NULL AS TIMESTAMP) AS at
    FROM region""",
)
def null_literal(c: Context) -> DataFrame:
    return c.table("region").select(
        "r_regionkey",
        scalars.null_of("string").alias("text"),
        scalars.null_of("bigint").alias("number"),
        scalars.null_of("timestamp").alias("at"),
    )


@query(
    "array_size",
    """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 0 WHEN c_custkey % 4 = 0 THEN NULL ELSE 2 END AS segments,
    CASE WHEN c_custkey % 9 = 0 OR c_custkey % 4 = 0 THEN NULL ELSE 'ALL' END AS second FROM customer""",
)
def array_size(c: Context) -> DataFrame:
    """Size and second element of arrays, some of them empty or missing."""
    segments = (
        F.when(every("c_custkey", 9), F.array().cast("array<string>"))
        .when(every("c_custkey", 4), None)
        .otherwise(F.array("c_mktsegment", F.lit("ALL")))
    )
    return c.table("customer").select(
        "c_custkey", F.size(segments).alias("segments"), F.get(segments, F.lit(1)).alias("second")
    )


@query(
    "array_get",
    """SELECT event_id, event_type AS first, CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS second,
    CAST(NULL AS VARCHAR) AS third FROM events""",
)
def array_get(c: Context) -> DataFrame:
    """Elements by position; NULL past the end."""
    short = F.array("event_type")
    values = F.when(every("event_id", 3), F.array("event_type", F.col("user_id").cast("string"))).otherwise(short)
    places = {name: F.get(values, F.lit(i)) for i, name in enumerate(("first", "second", "third"))}
    return c.table("events").select("event_id", *[column.alias(name) for name, column in places.items()])


@query(
    "ratio",
    """SELECT o_orderkey, CASE WHEN o_custkey % 5 <> 0 THEN o_totalprice / (o_custkey % 5) END AS share,
    coalesce(CASE WHEN o_custkey % 5 <> 0 THEN o_totalprice / (o_custkey % 5) END, 0) AS share_or_zero FROM orders""",
)
def ratio(c: Context) -> DataFrame:
    """Division that is NULL, or a given value, by zero."""
    price, by = F.col("o_totalprice"), F.col("o_custkey") % 5
    return c.table("orders").select(
        "o_orderkey",
        scalars.ratio(price, by).alias("share"),
        scalars.ratio(price, by, F.lit(0.0)).alias("share_or_zero"),
    )
