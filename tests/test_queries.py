import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from compare import check, connect
from starledger.workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# A part of the registered queries, one or more of each family; compare.py runs them all.
NAMES = """scan_json_multiline merge_pages bronze_envelope_write flatten_order_header flatten_order_line
flatten_order_tender explode_arrays menu_duplicates order_date_mapping dim_date star_dim_product star_fact_sales
star_fact_inventory validate_relationship reconcile_layers_diff orphans_distinct hierarchy_rollup total_orders
repeat_customers_by_location measures_by_date previous_month_sales_by_month bidirectional_filter
top10_items_by_sales top10_customers_by_sales sales_by_payment_status product_table surrogate_key_ties""".split()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, con, name):
    ok, text = check(spark, con, SF, entry_point.queries()[name], entry_point.oracle_sql()[name])
    assert ok, text


def test_a_wrong_statement_is_noticed(spark, con):
    ok, _ = check(spark, con, SF, entry_point.queries()["row_counts"], "SELECT count(*) + 1 AS total_rows FROM lineitem")
    assert not ok


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES) <= set(entry_point.queries())


@pytest.mark.parametrize(
    "name", ["top10_items_by_sales", "product_table", "reconcile_layers_diff", "validate_relationship", "merge_pages", "kpi_cards_sales_overview"]
)
def test_plans_hold_no_cross_join_python_or_global_window(spark, name):
    df = entry_point.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "Window"):
        assert node not in plan


@pytest.mark.parametrize("hidden", ["public_tokenizers", "starledger.llm", "corpus_pipeline", "zstandard"])
def test_the_star_queries_stay_when_a_training_data_dependency_is_missing(hidden):
    code = (
        f"import sys; sys.path.insert(0, {str(Path(entry_point.__file__).parent)!r}); sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as e; from starledger.workload.registry import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) and len(QUERIES) > 200 and set(e.oracle_sql()) == set(QUERIES)"
    )
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], check=True, timeout=120)
