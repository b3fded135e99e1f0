import datetime as dt

from pyspark.sql import functions as F

from starledger.operators import keys
from starledger.plans import gold


def counted(df):
    return sorted(map(str, df.collect()))


def test_a_join_of_which_no_column_is_read_still_repeats_rows_and_moves_none(spark):
    lines = spark.createDataFrame([("o1", "1", "v1"), ("o1", "2", "v2"), ("o2", "1", None), (None, "9", "v1"), ("o3", "1", "v9")], "order_id string, order_line_id string, variation_id string")
    orders = spark.createDataFrame([("o1", 1, 5), ("o2", 2, 6), ("o2", 3, 6), (None, 4, 7), (None, 5, 7)], "order_id string, order_key long, location_key long")
    products = spark.createDataFrame([("v1", 1), ("v1", 2), ("v1", 3), (None, 4), (None, 5), ("v2", 6)], "variation_id string, product_key long")
    read = ["order_id", "order_line_id", "variation_id"]
    want = lines.join(orders.select("order_id"), "order_id", "left").join(products.select("variation_id"), "variation_id", "left").select(*read)
    got = gold.join_sales(lines, orders, products, read)
    assert counted(got) == counted(want) and got.count() == 10
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    keyed = gold.join_sales(lines, orders, products, [*read, "order_key", "location_key", "product_key"])
    whole = lines.join(orders, "order_id", "left").join(products, "variation_id", "left").select(*keyed.columns)
    assert counted(keyed) == counted(whole)


def test_orders_of_few_columns_are_joined_as_whole_ones(spark):
    day = dt.date(2026, 7, 1)
    header = spark.createDataFrame([("a", "c1", "l1"), ("b", None, "l2"), ("b", "c2", None), (None, "c1", "l1")], "order_id string, customer_id string, location_id string")
    mapping = spark.createDataFrame([("x", "a", day), ("y", "a", None), ("z", None, day)], "business_order_id string, order_id string, reporting_date date")
    customer = spark.createDataFrame([("c1", 1), ("c1", 2), ("c2", 3), (None, 4)], "customer_id string, customer_key long")
    location = spark.createDataFrame([("l1", 1), ("l2", 2)], "location_id string, location_key long")
    date = spark.createDataFrame([(day, 20260701)], "date date, date_key int")
    by_hand = (
        header.join(mapping.select("order_id", "reporting_date"), "order_id", "left").join(customer, "customer_id", "left").join(location, "location_id", "left")
        .join(date.withColumnRenamed("date", "reporting_date"), "reporting_date", "left")
    )
    for columns in (["order_id"], ["order_id", "date_key"], ["order_id", "customer_key", "location_key"], ["order_id", "date_key", "customer_key", "location_key"]):
        assert counted(gold.join_order(header, mapping, customer, location, date, columns)) == counted(by_hand.select(*columns)), columns


def test_columns_that_only_order_are_not_carried_further(spark):
    rows = spark.createDataFrame([(i % 7 or None, f"r{i % 50}", i % 11) for i in range(400)], "a int, b string, payload int").repartition(5)
    whole, few = keys.surrogate_key(rows, ["a", "b"], "k", carry=True), keys.surrogate_key(rows, ["a", "b"], "k", carry=True, keep=["payload"])
    assert few.columns == ["k", "payload"] and counted(few) == counted(whole.select("k", "payload"))
    assert counted(keys.surrogate_key(rows, ["a", "b"], "k", keep=["payload"])) == counted(few)


def test_carried_copies_are_spread_over_ranges_without_sorting_them_first(spark, monkeypatch):
    staged, stage = [], keys.stage
    monkeypatch.setattr(keys, "stage", lambda df, label: staged.append((df, stage(df, label))) or staged[-1][1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = keys.surrogate_key(spark.range(40000).select(F.lit("same").alias("k"), F.lit(1).alias("v")).repartition(8), ["k"], "n", carry=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.n for r in got.collect()) == list(range(1, 40001))
    (plan, placed), = staged
    sizes = [r["count"] for r in placed.groupBy(F.shiftright("__place", 33)).count().collect()]
    assert sum(sizes) == 40000 and max(sizes) < 40000 / 4
    assert plan._jdf.queryExecution().analyzed().toString().count("Sort [") == 1
