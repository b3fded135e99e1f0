import datetime as dt

import pytest
from pyspark.sql import functions as F

from starledger.operators import keys
from starledger.plans import measures
from starledger.plans.gold import FACT_COLUMNS
from starledger.plans.star import columns_read
from starledger.sources.schemas import narrowed
from starledger.workload.roles import Layers


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A few rows of every table that the star is built from; some keys repeat, some are NULL."""
    at = tmp_path_factory.mktemp("tables")
    day = lambda n: dt.datetime(2026, 7, 1 + n % 20)
    rows = {
        "nation": ([(n, n % 3, f"N{n}") for n in range(27)], "n_nationkey int, n_regionkey int, n_name string"),
        "customer": ([(c, f"c{c}", "M", c % 27, 1.0) for c in (1, 2, 3, 3, 11)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int, c_acctbal double"),
        "part": ([(p, f"p{p}", f"Brand#{p % 5}", "SMALL", p, 9.5) for p in (1, 2, 2, 41, 7)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": (
            [(o if o % 31 else None, o % 13, "FOP"[o % 3], f"{o % 4 + 1}-X", 100.0 * o, day(o)) for o in range(1, 120)] + [(5, 3, "F", "1-X", 7.0, day(5))],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_totalprice double, o_orderdate timestamp",
        ),
        "lineitem": (
            [(o % 130, o % 9 if o % 17 else None, o % 40, 1 + o % 3, float(o % 50), 10.0 * o, 0.01 * (o % 11), 0.02, "NAR"[o % 3], "OF"[o % 2], day(o)) for o in range(400)] * 2,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
    }
    for name, (data, schema) in rows.items():
        df = spark.createDataFrame(data, schema)
        if name == "lineitem":
            df = df.filter("l_quantity > 0")
        df.write.parquet(f"{at}/{name}.parquet")
    return str(at)


def counted(df):
    return sorted(map(str, df.collect()))


def test_facts_of_few_columns_hold_the_rows_of_the_stored_ones(spark, folder):
    wanted = {
        "fact_sales": {"total_amount", "date_key", "customer_key", "product_key"}, "fact_order": {"order_key", "location_key", "total_amount"},
        "fact_payment": {"amount", "payment_status", "date_key"}, "fact_inventory": {"quantity", "product_key", "location_key", "date_key"},
    }
    part, whole = Layers(spark, folder).only(wanted), Layers(spark, folder)
    for name, columns in wanted.items():
        few, all_of = part[name], whole[name]
        assert columns <= set(few.columns) and len(few.columns) < len(all_of.columns), name
        shared = [c for c in few.columns if c in FACT_COLUMNS[name]]
        assert counted(few.select(*shared)) == counted(all_of.select(*shared)), name
        key = few.columns[0]
        assert sorted(r[0] for r in few.select(key).collect()) == list(range(1, all_of.count() + 1))


def test_measures_leave_whole_layers_unbuilt(spark, folder):
    layers, whole = Layers(spark, folder), Layers(spark, folder)
    names = ["daily_sales", "total_orders", "payment_success_rate", "total_inventory_quantity", "average_inventory_quantity", "repeat_customers"]
    got = measures.measure(layers, names, ["dim_location.location_name"])
    large = {"raw_orders", "raw_order_lines", "raw_payments", "raw_inventory", "order_header", "order_line", "payment", "inventory", *FACT_COLUMNS}
    assert not large & set(layers._stored)
    want = measures.measure({t: whole[t] for t in whole if t.startswith(("fact", "dim"))}, names, ["dim_location.location_name"])
    assert counted(got) == counted(want) and got.count() > 3


def test_a_fact_is_built_again_only_for_columns_it_lacks(spark, folder):
    layers = Layers(spark, folder)
    first = layers.fact("fact_order", {"date_key"})
    assert layers.fact("fact_order", {"order_key", "date_key"}) is first
    more = layers.fact("fact_order", {"customer_key"})
    assert {"date_key", "customer_key"} <= set(more.columns) and layers.fact("fact_order", {"date_key"}) is more


def test_every_measure_says_what_it_reads():
    for name, part in measures.PARTS.items():
        read = columns_read({}, {name: part})
        assert part.table == "dim_customer" or read[part.table], name
        assert {part.per, part.distinct} - {None} <= set(part.reads), name
    assert columns_read({}, {"x": measures.Part("fact_sales", lambda: F.count("*"))})["fact_sales"] is None


def test_carried_rows_are_numbered_as_joined_ones(spark):
    rows = [(i % 7 or None, f"r{i % 50}", i % 11) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b string, payload int").repartition(5)
    got, want = (keys.surrogate_key(df, ["a", "b"], "k", carry=c) for c in (True, False))
    assert "Join" in want._jdf.queryExecution().analyzed().toString() and "shuffle_hash" not in got._jdf.queryExecution().logical().toString()
    assert counted(got) == counted(want)


def test_narrowed_schemas_reach_into_arrays():
    record = narrowed("orders", ["id", "line_items.uid", "line_items.total_money.amount"])["orders"].dataType.elementType
    assert record.simpleString() == "struct<id:string,line_items:array<struct<uid:string,total_money:struct<amount:bigint>>>>"
