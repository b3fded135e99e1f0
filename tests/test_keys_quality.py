import itertools
import random

import pytest
from pyspark.sql import functions as F

from starledger.operators import keys, quality
from starledger.plans.report import top_n
from starledger.session import stage


def test_surrogate_key_is_dense_and_ordered_with_a_hot_group_of_copies(spark):
    n = 9000
    # A third of all rows are copies of one row; another sixth share a missing key.
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"),
    ).repartition(7)
    got = keys.surrogate_key(df, ["k"], "key")
    assert got.columns[0] == "key"
    rows = sorted(got.collect())
    assert [r["key"] for r in rows] == list(range(1, n + 1))
    values = [r["k"] for r in rows]
    assert values == sorted(values, key=lambda k: (k is not None, k or ""))
    assert sorted((r["k"] or "", r["v"]) for r in rows) == sorted((r["k"] or "", r["v"]) for r in df.collect())


def test_surrogate_key_spreads_copies_over_ranges(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(keys, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    # Small ranges are put together at run time; keep them apart to see how rows were spread.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keys.surrogate_key(spark.range(40000).select(F.lit("same").alias("k")).repartition(8), ["k"], "key")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in staged[0].groupBy(F.shiftright("__place", 33)).count().collect()]
    assert sum(sizes) == 40000
    assert max(sizes) < 40000 / 4


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), (None, 5, "w")], "k string, t int, v string")
    assert sorted(tuple(r) for r in keys.latest_per_key(df, ["k"], ["t"]).select(F.coalesce("k", F.lit("-")), "v").collect()) == [
        ("-", "w"),
        ("a", "y"),
    ]
    assert keys.first_per_key(df.filter("k = 'a'"), ["k"], ["t"]).first()["v"] == "z"


@pytest.mark.parametrize("seed", range(4))
def test_reconcile_amounts_counts_pairs_like_a_join(spark, seed):
    draw = random.Random(seed)
    side = lambda: [(draw.choice(["a", "b", None]), draw.choice([1, 2, None])) for _ in range(40)]
    left, right = side(), side()
    got = quality.reconcile_amounts(
        spark.createDataFrame(left, "k string, x int"), spark.createDataFrame(right, "k string, y int"), ("k", "k"), "x", "y"
    ).first()
    pairs = [(x, y) for (k, x), (j, y) in itertools.product(left, right) if k is not None and k == j]
    equal = sum(x is not None and x == y for x, y in pairs)
    different = sum(x is not None and y is not None and x != y for x, y in pairs)
    assert tuple(got) == (len(pairs), equal, different)


def test_null_keys_are_orphans_and_duplicates(spark):
    fact = spark.createDataFrame([(1,), (1,), (9,), (None,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,)], "d int")
    report = quality.validate_relationship(fact, dim, "f", "d", "k", "d").first()
    assert (report["fact_rows"], report["null_foreign_keys"], report["orphan_records"]) == (5, 2, 3)
    assert tuple(quality.orphan_keys(fact, dim, "k", "d").first()) == (2, 1)
    assert quality.duplicate_keys(fact, ["k"]).first()[0] == 2
    assert tuple(quality.validate_key(fact, "f", "k").first()) == ("f", 5, 2, 2)
    assert quality.orphans(fact, dim, {"k": "d"}).count() == 3
    assert quality.orphans(fact, dim, {"k": "d"}, skip_null=True).count() == 1


def test_reports_over_no_rows(spark):
    none = spark.createDataFrame([], "k int, a int")
    assert tuple(quality.validate_key(none, "t", "k").first()) == ("t", 0, 0, 0)
    assert tuple(quality.reconcile_amounts(none, none, ("k", "k"), "a", "a").first()) == (0, 0, 0)


def test_reconcile_layers_of_equal_layers_differ_by_zero(spark):
    df = spark.createDataFrame([(1, 2), (3, None)], "a int, b int")
    got = quality.reconcile_layers(df, df, {"a": ("a", "a"), "b": ("b", "b")}, diff=True).first()
    assert tuple(got) == (0, 0, 0)


def test_top_n_keeps_ties_and_nulls_last(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1), ("e", None)], "g string, v int")
    picked = lambda n: sorted(r["g"] for r in top_n(df, "v", n).collect())
    assert picked(2) == ["a", "b", "c"]
    assert picked(4) == ["a", "b", "c", "d"]
    assert picked(5) == ["a", "b", "c", "d", "e"]


def test_keys_sort_no_payload_and_agree_with_numbering_in_order(spark):
    rows = [(i % 7 or None, "same" if i % 3 else f"r{i}", f"payload {i % 11}") for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b string, payload string").repartition(5)
    got = keys.surrogate_key(df, ["a"], "k")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and all("__range" in line for line in plan.splitlines() if "Sort [" in line)
    out = got.collect()
    assert [r.k for r in sorted(out, key=lambda r: r.k)] == list(range(1, 401)) and got.columns[0] == "k"
    assert [r.a for r in sorted(out, key=lambda r: r.k)] == sorted((r[0] for r in rows), key=lambda a: (a is not None, a))
    assert sorted(map(str, (tuple(r)[1:] for r in out))) == sorted(map(str, rows))


@pytest.mark.parametrize("order", [["n"], ["n", "s"]])
def test_latest_and_first_rows_agree_with_comparing_whole_rows(spark, order):
    rows = [(i % 5 or None, i * 7 % 4 if i % 6 else None, f"s{i % 3}", i % 9) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, n int, s string, x int").repartition(4)
    low = lambda v: (v is not None, v if v is not None else 0)
    at = {"n": 1, "s": 2}
    rank = lambda r: ([low(r[at[c]]) if c == "n" else r[at[c]] for c in order], [low(r[0]), low(r[1]), r[2], r[3]])
    for pick, best in ((keys.latest_per_key, max), (keys.first_per_key, min)):
        want = {best((r for r in rows if r[0] == k), key=rank) for k in {r[0] for r in rows}}
        assert {tuple(r) for r in pick(df, ["k"], order).collect()} == want


def test_relationships_of_numbers_and_of_text_count_alike(spark):
    tables = {
        "f": spark.createDataFrame([(1, "a", 1), (2, "b", None), (None, None, 3), (9, "z", 3)], "n int, t string, m bigint"),
        "d": spark.createDataFrame([(1, "a"), (2, "c")], "id bigint, t string"),
        "e": spark.createDataFrame([("3",)], "id string"),
    }
    pairs = [("f", "d", "n", "id"), ("f", "d", "t", "t"), ("f", "e", "m", "id")]
    got = {(r.fact_key, r.dim_name): (r.fact_rows, r.null_foreign_keys, r.orphan_records) for r in quality.validate_relationships(tables, pairs).collect()}
    assert got == {("n", "d"): (4, 1, 2), ("t", "d"): (4, 1, 3), ("m", "e"): (4, 1, 2)}
