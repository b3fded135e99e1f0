import re

import pytest
from pyspark.sql import functions as F
from test_narrow_facts import counted, folder  # noqa: F401  (the fixture)

from starledger.plans import measures
from starledger.plans.gold import FACT_COLUMNS
from starledger.plans.report import between_dates
from starledger.plans.star import columns_read, limited_by_stock
from starledger.workload import checks, roles
from starledger.workload.registry import Context
from starledger.workload.roles import Layers

LARGE = {"raw_orders", "raw_order_lines", "raw_payments", "raw_inventory", "order_header", "order_line", "payment", "inventory", *FACT_COLUMNS}


@pytest.fixture(scope="module")
def whole(spark, folder):  # noqa: F811
    layers = Layers(spark, folder)
    return {t: layers[t] for t in layers if t.startswith(("fact", "dim")) or t in ("order_line", "inventory")}


def test_a_stock_filter_reads_a_narrow_fact(spark, folder, whole):  # noqa: F811
    layers, names = Layers(spark, folder), ["total_sales", "total_inventory_quantity"]
    few = F.col("quantity") < 0

    def limited(tables, **reads):
        tables, filters = limited_by_stock(tables, few)
        return measures.measure(tables, names, ["dim_location.location_name"], filters, **reads)

    got = counted(limited(layers, reads={"fact_inventory": ["quantity"]}))
    assert not LARGE & set(layers._stored)
    assert got == counted(limited(whole)) and len(got) > 3
    # A fact's filter that does not say what it reads may read any column.
    assert counted(limited(layers)) == got and "fact_inventory" in layers._stored


def test_a_location_filter_reads_narrow_facts(spark, folder, whole):  # noqa: F811
    layers, filters = Layers(spark, folder), {"dim_location": F.col("state") == "R1"}
    names = ["total_sales", "total_orders", "total_payments", "total_inventory_quantity", "total_customers"]
    got = counted(measures.measure(layers, names, filters=filters))
    assert not LARGE & set(layers._stored)
    assert got == counted(measures.measure(whole, names, filters=filters)) and "None" not in got[0]


def test_the_day_before_under_a_location_filter_reads_a_narrow_fact(spark, folder, whole):  # noqa: F811
    layers, filters = Layers(spark, folder), {"dim_location": F.col("state") == "R1"}
    got = counted(measures.measure(layers, "previous_day_sales", ["dim_customer.address_locality"], filters))
    assert not LARGE & set(layers._stored)
    assert got == counted(measures.measure(whole, "previous_day_sales", ["dim_customer.address_locality"], filters)) and got


def _scans_of_facts(df):
    """The scans of numbered rows that lie in months, as they were run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and "date_key" in line and "__place" in line and "date_month" in line]


def test_a_date_slicer_reads_narrow_facts_that_lie_in_months(spark, folder, whole):  # noqa: F811
    layers, names = Layers(spark, folder), ["total_sales", "total_orders"]
    days = [r.date for r in measures.measure(whole, "total_sales", ["dim_date.date"]).collect() if r.date]
    filters = between_dates(min(days), max(days))
    df = measures.measure(layers, names, ["dim_date.date"], filters)
    got = counted(df)
    assert not LARGE & set(layers._stored)
    assert got == counted(measures.measure(whole, names, ["dim_date.date"], filters)) and len(got) >= len(days)
    df.collect()
    scans = _scans_of_facts(df)
    assert {re.search(r"/(\w+_key)-", line)[1] for line in scans} == {"sales_key", "order_key"} and all("dynamicprun" in line for line in scans), scans


def test_the_month_before_in_a_slice_reads_a_narrow_fact(spark, folder, whole):  # noqa: F811
    layers = Layers(spark, folder)
    days = [r.date for r in measures.measure(whole, "previous_month_sales", ["dim_date.date"]).collect() if r.date]
    filters = between_dates(min(days), max(days))
    got = counted(measures.measure(layers, "previous_month_sales", ["dim_product.item_name"], filters))
    assert not LARGE & set(layers._stored)
    assert got == counted(measures.measure(whole, "previous_month_sales", ["dim_product.item_name"], filters)) and got


def test_a_fact_is_built_again_to_lie_in_months(spark, folder):  # noqa: F811
    layers = Layers(spark, folder)
    plain = layers.fact("fact_sales", {"date_key", "total_amount"})
    in_months = layers.fact("fact_sales", {"date_key"}, months=True)
    assert in_months is not plain and counted(plain.select(*sorted(plain.columns))) == counted(in_months.select(*sorted(plain.columns)))
    assert layers.fact("fact_sales", {"total_amount"}) is in_months


def test_filters_name_the_keys_they_are_reached_by():
    read = columns_read({}, {"stock": measures.PARTS["stock"]}, ["dim_location", "fact_inventory"], {"fact_inventory": ["inventory_state"]})
    assert read["fact_inventory"] == {"quantity", "location_key", "inventory_state"}
    assert columns_read({}, {"stock": measures.PARTS["stock"]}, ["fact_inventory"])["fact_inventory"] is None


@pytest.fixture
def fresh(spark, folder, monkeypatch):  # noqa: F811
    """Layers of its own for each query."""
    made = Layers(spark, folder)
    monkeypatch.setattr(roles, "layers", lambda *_: made)
    return Context(spark, folder), made


def test_fact_keys_are_checked_on_facts_of_keys(fresh, whole):
    context, layers = fresh
    got = {r.table_name: tuple(r)[1:] for r in checks.validate_fact_key(context).collect()}
    assert not LARGE & set(layers._stored)
    assert got == {t: (whole[t].count(), 0, 0) for t in FACT_COLUMNS}


@pytest.mark.parametrize("query", [checks.reconcile_layers_diff, checks.reconcile_layers, checks.cross_one_row])
def test_layers_are_reconciled_by_the_columns_that_are_compared(fresh, whole, query):
    context, layers = fresh
    got = query(context).first().asDict()
    assert not LARGE & set(layers._stored)
    if query is checks.reconcile_layers:
        assert got["silver_row_count"] == whole["order_line"].count() and got["gold_row_count"] == whole["fact_sales"].count()
    elif query is checks.cross_one_row:
        assert got["silver_row_count"] == whole["inventory"].count() and got["gold_row_count"] == whole["fact_inventory"].count()
    else:
        assert got["row_count_difference"] == whole["order_line"].count() - whole["fact_sales"].count() != 0


def test_whole_sales_are_numbered_as_the_stored_ones_without_storing_what_is_below(fresh, whole):
    context, layers = fresh
    got, stored = layers.entire("fact_sales"), whole["fact_sales"]
    assert not LARGE & set(layers._stored)
    assert got.columns == stored.columns and counted(got) == counted(stored)
    joined = checks.fact_sales_joins(context)
    assert not LARGE & set(layers._stored)
    assert counted(joined) == counted(stored.select(*FACT_COLUMNS["fact_sales"]))
