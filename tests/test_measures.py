import calendar
import datetime as dt
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starledger.plans import measures
from starledger.plans.report import between_dates
from starledger.plans.star import limited_by_stock, related
from starledger.workload.roles import layers


@pytest.fixture(scope="module")
def star(spark):
    make = spark.createDataFrame
    return {
        "dim_date": make([(1, dt.date(2024, 1, 31)), (2, dt.date(2024, 2, 1)), (3, dt.date(2024, 2, 29)), (4, dt.date(2024, 3, 31))], "date_key int, date date"),
        "dim_customer": make([(1, "A"), (2, "B"), (3, "C")], "customer_key int, customer_name string"),
        "dim_product": make([(1, "v1", "Soup"), (2, "v2", "Soup"), (3, "v3", "Tea")], "product_key int, variation_id string, item_name string"),
        "dim_location": make([(1, "L1"), (2, "L2")], "location_key int, location_name string"),
        "fact_order": make([(1, "o1", 1, 1, 1), (2, "o2", 2, 1, 1), (3, "o3", 3, None, 2), (4, "o4", 4, None, 2)], "order_key int, order_id string, date_key int, customer_key int, location_key int"),
        "fact_sales": make(
            [(1, 1, 1, 1, "v1", 100, 1.0), (2, 1, 2, 1, "v2", 300, 2.0), (3, None, 3, 2, "v3", 500, 1.0), (4, None, None, 2, "vX", None, 4.0)],
            "date_key int, customer_key int, product_key int, location_key int, variation_id string, total_amount bigint, quantity double",
        ),
        "fact_payment": make([(1, 1, "COMPLETED", 50), (2, 2, "FAILED", 70)], "payment_key int, date_key int, payment_status string, amount bigint"),
        "fact_inventory": make([(1, 1, 1, 5), (1, 1, 1, -1), (2, 3, 2, 0)], "date_key int, product_key int, location_key int, quantity bigint"),
    }


def one(star, *names, **kw):
    return tuple(measures.measure(star, list(names), **kw).first())


def by(star, names, group, **kw):
    return {r[0]: tuple(r)[1:] for r in measures.measure(star, names, [group], **kw).collect()}


def test_blank_customer_counts_as_a_customer(star):
    assert one(star, "customers_with_orders", "repeat_customers", "repeat_customer_rate") == (2, 2, 1.0)


def test_units(star):
    assert one(star, "total_sales", "total_payment_amount") == (9.0, 120)


def test_stock_rows_put_one_product_in_both_counts(star):
    assert one(star, "products_in_stock", "out_of_stock_products", "average_inventory_quantity") == (1, 2, 2.0)


def test_items_group_by_name_and_unknown_products_are_blank(star):
    got = by(star, ["total_sales", "total_quantity_sold", "total_inventory_quantity"], "dim_product.item_name")
    assert got == {"Soup": (4.0, 3.0, 4), "Tea": (5.0, 1.0, 0), None: (None, 4.0, None)}


def test_never_blank_measures_show_members_without_facts(star):
    assert by(star, ["repeat_customers"], "dim_customer.customer_name") == {"A": (1,), "B": (0,), "C": (0,), None: (1,)}
    assert by(star, ["out_of_stock_products"], "dim_product.item_name") == {"Soup": (1,), "Tea": (1,)}


def test_a_fact_that_reaches_some_groups_is_repeated_under_the_others(star):
    rows = measures.measure(star, ["total_sales", "total_orders"], ["dim_location.location_name", "dim_product.item_name"]).collect()
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows}
    assert got == {("L1", "Soup"): (4.0, 2), ("L2", "Tea"): (5.0, 2), ("L2", None): (None, 2)}


def test_mostly_null_keys_agree_and_sums_are_reduced_before_the_join(spark, star):
    facts = spark.range(1000).selectExpr("cast(if(id % 10 = 0, 1 + id % 3, null) as int) customer_key", "1 date_key", "1 location_key", "'v1' variation_id", "1 product_key", "id as total_amount", "1.0d quantity", "cast(id as int) order_key", "cast(id as string) order_id")
    tables = {**star, "fact_sales": facts, "fact_order": facts}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = measures.measure(tables, ["total_sales", "repeat_customers"], ["dim_customer.customer_name"])
        got = {r[0]: (r[1], r[2]) for r in df.collect()}
        plan = measures.measure(tables, "total_sales", ["dim_customer.customer_name"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {n: (sum(i for i in range(0, 1000, 10) if i % 3 == k) / 100, 1) for k, n in enumerate("ABC")}
    assert got == {**want, None: (sum(i for i in range(1000) if i % 10) / 100, 1)}
    assert plan.index("Join") < plan.rindex("HashAggregate")


def test_no_path_repeats_the_total(star):
    assert by(star, "total_sales", "fact_payment.payment_status") == {"COMPLETED": (9.0,), "FAILED": (9.0,)}


def test_completed_replaces_the_status_group(star):
    got = by(star, ["total_payments", "completed_payments"], "fact_payment.payment_status")
    assert got == {"COMPLETED": (1, 1), "FAILED": (1, 1)}


def test_filters_reach_related_facts_only(star):
    assert one(star, "total_sales", "total_orders", "total_customers", filters={"dim_location": F.col("location_name") == "L1"}) == (4.0, 2, 3)
    assert one(star, "average_order_value", "out_of_stock_products", "total_sales", filters={"dim_location": F.lit(False)}) == (0.0, 0, None)


def test_stock_condition_limits_sales(star):
    tables, filters = limited_by_stock(star, F.col("quantity") > 0)
    assert one(tables, "total_sales", filters=filters) == (1.0,)


def test_previous_periods_skip_gaps_and_follow_month_ends(spark, star):
    daily = measures.daily_totals(star)
    day = {r["date"]: r for r in measures.previous_period(daily, star["dim_date"], "day").collect()}
    assert day[dt.date(2024, 2, 1)]["previous_sales"] == 1.0 and day[dt.date(2024, 2, 1)]["growth"] == 2.0
    assert day[dt.date(2024, 2, 29)]["previous_sales"] is None
    month = {r["date"]: r for r in measures.previous_period(daily, star["dim_date"], "month").collect()}
    assert month[dt.date(2024, 2, 29)]["previous_sales"] is None
    assert month[dt.date(2024, 3, 31)]["previous_sales"] == 5.0 and month[dt.date(2024, 3, 31)]["growth"] == -1.0
    whole = {r["year_month_number"]: r["previous_sales"] for r in measures.previous_month(daily, star["dim_date"]).collect()}
    assert whole == {202401: None, 202402: 1.0, 202403: 8.0}
    assert tuple(measures.previous_total(daily, star["dim_date"], "month").first())[:2] == (9.0, 5.0)


# --- earlier periods under any grouping -----------------------------------------------------------------------


def shift_back(day, unit):
    if unit == "day":
        return day - dt.timedelta(1)
    year, month = (day.year, day.month - 1) if day.month > 1 else (day.year - 1, 12)
    return dt.date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


def brute_previous(star, unit, of_date, of_row, selected=lambda day: True):
    """Sales of the dates moved back, per group of dates and of rows."""
    days = {r.date_key: r.date for r in star["dim_date"].collect()}
    chosen, out = defaultdict(set), defaultdict(int)
    for day in days.values():
        if selected(day):
            chosen[of_date(day)].add(day)
    for group, dates in chosen.items():
        moved = {shift_back(day, unit) for day in dates}
        for day in dates:
            last = calendar.monthrange(day.year, day.month)[1]
            if unit == "month" and day.day == last and day - dt.timedelta(1) in dates:
                at = shift_back(day, unit)
                moved |= {at.replace(day=d) for d in range(at.day + 1, calendar.monthrange(at.year, at.month)[1] + 1)}
        for r in star["fact_sales"].collect():
            if r.date_key in days and days[r.date_key] in moved and r.total_amount is not None:
                out[group, of_row(r)] += r.total_amount
    return {k: v / 100 for k, v in out.items()}


@pytest.fixture(scope="module")
def years(spark, star):
    """Two years of days, sales on most of them, in several places; some without a date."""
    first = dt.date(2023, 1, 1)
    days = [first + dt.timedelta(i) for i in range(731)]
    dates = [(i, d, d.year * 100 + d.month, d.strftime("%A")) for i, d in enumerate(days)]
    sales = [(i if i % 11 else None, i % 4 or None, i % 3, 1 + i % 2, f"v{i % 3}", i * 37 % 1009, 1.0) for i in range(0, 731) if i % 7]
    return {
        **star,
        "dim_date": spark.createDataFrame(dates, "date_key int, date date, year_month_number int, day_name string"),
        "fact_sales": spark.createDataFrame(sales, "date_key int, customer_key int, product_key int, location_key int, variation_id string, total_amount bigint, quantity double"),
    }


@pytest.mark.parametrize("unit", ["day", "month"])
def test_previous_periods_follow_any_date_group_and_filter(years, unit):
    name, place = f"previous_{unit}_sales", {1: "L1", 2: "L2"}
    by_group = {"date": lambda d: d, "year_month_number": lambda d: d.year * 100 + d.month, "day_name": lambda d: d.strftime("%A")}
    for column, of_date in by_group.items():
        got = {((r[0], r[1])): r[2] for r in measures.measure(years, name, [f"dim_date.{column}", "dim_location.location_name"]).collect()}
        assert got == pytest.approx(brute_previous(years, unit, of_date, lambda r: place[r.location_key]))
    item = {"v1": "Soup", "v2": "Soup", "v3": "Tea"}
    inside = lambda d: dt.date(2024, 2, 20) <= d <= dt.date(2024, 3, 30)
    filters = {"dim_date": F.col("date").between("2024-02-20", "2024-03-30")}
    got = {r[0]: r[1] for r in measures.measure(years, name, ["dim_product.item_name"], filters).collect()}
    want = brute_previous(years, unit, lambda d: None, lambda r: item.get(r.variation_id), inside)
    assert got == pytest.approx({k[1]: v for k, v in want.items()})
    whole = brute_previous(years, unit, lambda d: None, lambda r: None)
    assert measures.measure(years, name).first()[0] == pytest.approx(whole[None, None])


def test_growth_needs_both_periods(years):
    growth = {r[0]: r[1] for r in measures.measure(years, "monthly_sales_growth_pct", ["dim_date.year_month_number"]).collect()}
    sales = {r[0]: r[1] for r in measures.measure(years, "total_sales", ["dim_date.year_month_number"]).collect()}
    assert growth[202402] == pytest.approx((sales[202402] - sales[202401]) / sales[202401]) and 202301 not in growth


# --- rows reduced before joins ----------------------------------------------------------------------------------

DISTINCT = [n for n, m in measures.MEASURES.items() if any(measures.PARTS[p].distinct or measures.PARTS[p].per for p in m.parts)]


@pytest.mark.parametrize("group", ["dim_location.location_name", "dim_customer.address_locality"])
def test_every_distinct_part_is_reduced_before_its_join(spark, group):
    star = layers(spark, "/root/testdata/sf0.001")
    names = [n for n in DISTINCT if all(related(measures.PARTS[p].table, group.split(".")[0]) for p in measures.MEASURES[n].parts)]
    assert len(DISTINCT) >= 15 and len(names) >= 8
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in names:
            optimized = measures.measure(star, name, [group])._jdf.queryExecution().optimizedPlan().toString()
            # Below every join to a dimension there is an aggregate on the fact's side before its relation is read.
            lines = optimized.splitlines()
            depth = lambda line: len(re.match(r"[ :+|-]*", line).group())
            joins = [i for i, line in enumerate(lines) if "Join LeftOuter" in line]
            for i in joins:
                below = next(j for j in range(i + 1, len(lines)) if "Aggregate" in lines[j] or "Relation" in lines[j])
                assert "Aggregate" in lines[below] and depth(lines[below]) > depth(lines[i]), (name, optimized)
            assert joins or group.split(".")[0] == measures.PARTS[measures.MEASURES[name].parts[0]].table
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_mostly_null_keys_are_dealt_out_and_counted_once(spark, star):
    facts = spark.range(2000).selectExpr(
        "cast(if(id % 10 = 0, 1 + id % 3, null) as int) customer_key", "1 date_key", "cast(1 + id % 2 as int) location_key", "cast(id % 7 as int) order_key", "if(id % 5 = 0, null, cast(id % 700 as string)) order_id",
    )
    tables, names = {**star, "fact_order": facts}, ["total_orders", "customers_with_orders", "customer_purchase_frequency", "repeat_customers"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = measures.measure(tables, names, ["dim_customer.customer_name"])
        got = {r[0]: tuple(r)[1:] for r in df.collect()}
        plan = measures.measure(tables, "total_orders", ["dim_customer.customer_name"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    rows, want = facts.collect(), {}
    for name, keys in {"A": [1], "B": [2], "C": [3], None: [None]}.items():
        some = [r for r in rows if r.customer_key in keys]
        n, buyers = len({r.order_id for r in some}), len({r.customer_key for r in some})
        want[name] = (n, buyers, n / buyers, int(len({r.order_key for r in some}) > 1))
    assert got == want
    # NULL keys are told apart by a second join key.
    assert re.search(r"SortMergeJoin \[customer_key#\d+, cast\(__deal#\d+ as bigint\)|SortMergeJoin \[customer_key#\d+, __deal", plan)


def test_never_blank_pairs_come_from_any_fact(star):
    rows = measures.measure(star, ["out_of_stock_products", "average_order_value"], ["dim_product.item_name", "dim_location.location_name"]).collect()
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows}
    assert got == {("Soup", "L1"): (1, 2.0), ("Tea", "L2"): (1, 2.5), (None, "L2"): (0, 0.0)}


# --- facts stored by month ----------------------------------------------------------------------------------------


def test_a_date_slicer_prunes_the_folders_of_both_facts(spark):
    star = layers(spark, "/root/testdata/sf0.001")
    filters = between_dates("2026-07-10", "2026-07-25")
    for names in (["total_sales", "total_orders"], ["previous_day_sales", "total_orders"]):
        df = measures.measure(star, names, ["dim_date.date"], filters)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        scans = [line for line in plan.splitlines() if "FileScan" in line and "date_month" in line]
        assert rows and len(scans) == 2 and all("dynamicprun" in line for line in scans), plan
    stored = star["fact_inventory"]
    files = stored.select("date_month", F.col("_metadata.file_path").alias("f")).distinct()
    assert files.count() <= 2 * files.select("date_month").distinct().count()
