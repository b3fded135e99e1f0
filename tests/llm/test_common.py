import random

import pytest
from pyspark.sql import functions as F

from starledger.llm.common import Scratch, hash_filter, may_hold, row_hash, split_by, without

#: Columns with the names that the split uses itself, and one that needs quoting.
SCHEMA = "doc_id long, text string, row string, open boolean, h long, bucket long, bitmap binary, __id long, __hash long, `a.b` int"


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "r", True, 7, 3, b"x", 1, 2, n) for n, (i, t) in enumerate(pairs)], SCHEMA)


def found(spark, pairs):
    rows = spark.createDataFrame(pairs, "doc_id long, text string")
    return rows.select(F.col("doc_id").alias("__id"), row_hash("text").alias("__hash"))


ROWS = [(1, "a"), (1, "b"), (2, ""), (2, None), (None, "a"), (None, None), (3, "c" * 200_000), (3, "c" * 200_000), (4, "d")]


@pytest.mark.parametrize("gone", [[], [(1, "a")], [(2, None)], [(2, "")], [(None, "a"), (None, None)], [(3, "c" * 200_000)] * 2, ROWS, [(9, "z")]])
def test_rows_go_by_id_and_text_and_clashing_columns_stay(spark, gone):
    docs = table(spark, ROWS)
    out = without(docs, found(spark, gone), row_hash("text"), Scratch(spark, "test-without"))
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    left = sorted((r["a.b"], r.doc_id, r.text, r.bitmap) for r in out.collect())
    assert left == [(n, i, t, b"x") for n, (i, t) in enumerate(ROWS) if (i, t) not in gone]


def test_nothing_goes_from_nothing(spark):
    assert without(table(spark, []), found(spark, ROWS), row_hash("text"), Scratch(spark, "test-without")).count() == 0


def test_a_split_loses_no_row_and_the_first_part_has_none_that_is_found(spark):
    rng = random.Random(5)
    rows = [(i, str(rng.random())) for i in range(3000)]
    listed = set(rng.sample(rows, 300))
    scratch = Scratch(spark, "test-split")
    clear, rest = split_by(table(spark, rows), found(spark, list(listed)), row_hash("text"), scratch)
    first = {(r.doc_id, r.text) for r in clear.collect()}
    second = {(r.row.doc_id, r.row.text) for r in rest.collect()}
    assert not first & second and first | second == set(rows) and listed <= second
    # A bitmap of 33 million bits takes few rows for others.
    assert len(second) < 310


@pytest.mark.parametrize("buckets", [1, 64])
def test_a_full_bitmap_clears_fewer_rows_and_never_a_wrong_one(spark, buckets):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    seen = hash_filter(keys.where("pmod(h, 2) = 0"), buckets)
    out = may_hold(keys, seen, "there", buckets).groupBy(F.expr("pmod(h, 2) = 0").alias("listed")).agg(F.count_if("there").alias("there"), F.count("*").alias("n"))
    got = {r.listed: (r.there, r.n) for r in out.collect()}
    assert got[True][0] == got[True][1] and got[False][0] < got[False][1]
