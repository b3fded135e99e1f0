import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starledger.functions import scalars
from starledger.operators import reshape
from starledger.plans import silver
from starledger.sources.schemas import envelope, narrowed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_flatten_structs_goes_depth_by_depth_and_appends(spark):
    df = spark.createDataFrame(
        [(1, ((5, "a"), 2), "x")], "id int, s struct<in:struct<n:int,t:string>,k:int>, last string"
    )
    flat = reshape.flatten_structs(df)
    assert flat.columns == ["id", "last", "s_k", "s_in_n", "s_in_t"]
    assert rows(flat) == [(1, "x", 2, 5, "a")]


def test_flatten_structs_refuses_equal_names(spark):
    df = spark.createDataFrame([(1, (2,))], "a_b int, a struct<b:int>")
    with pytest.raises(ValueError, match="a_b"):
        reshape.flatten_structs(df)


def test_explode_arrays_pairs_two_arrays_and_keeps_empty_ones(spark):
    df = spark.createDataFrame(
        [(1, [(1, ["p", "q"]), (2, [])], ["a", "b"]), (2, None, [])],
        "id int, s array<struct<n:int,tags:array<string>>>, t array<string>",
    )
    exploded = reshape.explode_arrays(df)
    assert exploded.columns == ["id", "t", "s_n", "s_tags"]
    assert rows(exploded) == sorted(
        [(1, t, n, tag) for t in "ab" for n, tag in [(1, "p"), (1, "q"), (2, None)]] + [(2, None, None, None)], key=repr
    )


def test_safe_col_gives_a_typed_null_for_an_absent_path(spark):
    df = spark.createDataFrame([((1,),)], "r struct<a:int>")
    got = df.select(reshape.safe_col(df.schema, "r.a", "a", "bigint"), reshape.safe_col(df.schema, "r.b.c", "c", "date"))
    assert got.dtypes == [("a", "bigint"), ("c", "date")]
    assert rows(got) == [(1, None)]


def test_drop_all_null_columns_keeps_required_ones(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None)], "a int, b string, c string")
    assert reshape.drop_all_null_columns(df, required=["c"]).columns == ["a", "c"]


def test_timestamps_by_keyword_and_unreadable_text(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z", "soon", "x")], "Created_At string, sold_at string, other string")
    got = reshape.parse_timestamps(df)
    assert rows(got) == [(dt.datetime(2024, 1, 2, 3, 4, 5), None, "x")]


@pytest.mark.parametrize(
    "text, to, expected",
    [
        ("12", "bigint", 12),
        (" 12 ", "bigint", 12),
        ("-12.9", "bigint", -12),
        ("1x", "bigint", None),
        ("", "int", None),
        ("99999999999", "int", None),
        ("1.25", "decimal(18,3)", Decimal("1.250")),
        ("one", "decimal(18,3)", None),
        ("1e2", "double", 100.0),
        ("yes", "boolean", True),
        ("maybe", "boolean", None),
        ("2024-02-30", "date", None),
        (None, "bigint", None),
    ],
)
def test_lenient_cast(spark, text, to, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(scalars.lenient_cast(F.col("t"), to)).first()[0] == expected


def test_reporting_date_spreads_ids_over_the_window(spark):
    ids = [("ORD-1",), ("ORD-50",), ("ORD-51",), ("ORD-0",), ("ORD-X",), (None,)]
    got = spark.createDataFrame(ids, "id string").select(scalars.reporting_date(F.col("id"), "2026-07-01", 50))
    day = dt.date(2026, 7, 1)
    last = dt.date(2026, 8, 19)
    assert [r[0] for r in got.collect()] == [day, last, day, last, None, None]


def test_names_flags_and_defaults(spark):
    df = spark.createDataFrame(
        [(None, None, None, [], ""), ("A", None, True, [("c",)], "v")],
        "g string, f string, b boolean, c array<struct<id:string>>, vat string",
    )
    got = df.select(
        scalars.full_name(F.col("g"), F.col("f")),
        scalars.bool_text(F.col("b")),
        scalars.first_or_default(F.col("c"), "id"),
        scalars.first_truthy(F.col("vat"), F.lit("ein")),
    )
    assert [tuple(r) for r in got.collect()] == [("", "None", "", "ein"), ("A", "True", "c", "v")]


def test_orders_without_lines_keep_a_row_and_snapshots_repeat(spark):
    body = '{"orders":[{"id":"1","line_items":[{"uid":"a","quantity":"2.5"}]},{"id":"2","line_items":[]},{"id":"3"}]}'
    raw = spark.createDataFrame([(body,), (body,)], "v string").select(
        F.from_json("v", envelope("orders")).alias("e")
    ).select("e.*")
    lines = silver.flatten_order_line(raw)
    assert len(lines.columns) == 19
    assert rows(lines.select("order_id", "order_line_id", "quantity")) == sorted(
        [("1", "a", Decimal("2.500")), ("2", None, None), ("3", None, None)] * 2, key=repr
    )
    assert silver.flatten_order_line(raw, outer=False).count() == 2
    assert len(silver.flatten_order_header(raw).columns) == 24


def test_narrowed_schema_keeps_only_named_fields():
    schema = narrowed("orders", ["id", "source.name", "total_money.amount"])
    record = schema["orders"].dataType.elementType
    assert record.simpleString() == "struct<id:string,total_money:struct<amount:bigint>,source:struct<name:string>>"


def test_latest_location_prefers_the_stamped_snapshot(spark):
    text = [
        ('{"ingested_at":"2026-01-01T00:00:00Z","locations":[{"id":"L","name":"old"}]}',),
        ('{"ingested_at":"2026-02-01T00:00:00Z","locations":[{"id":"L","name":"new"}]}',),
        ('{"locations":[{"id":"L","name":"unstamped"}]}',),
    ]
    raw = spark.createDataFrame(text, "v string").select(F.from_json("v", envelope("locations")).alias("e")).select("e.*")
    got = silver.latest_location(silver.flatten_location(raw))
    assert [r["location_name"] for r in got.collect()] == ["new"]
    assert "address_line_2" not in got.columns


def test_feeds_with_other_names_are_read_by_given_paths_and_headers(spark):
    from starledger.plans import menu, silver

    raw = spark.createDataFrame([([("P1", ("own product",))],)], "payments array<struct<id:string,application_details:struct<vendor_product:string>>>")
    assert silver.flatten_payment(raw).first().application_product is None
    assert silver.flatten_payment(raw, paths={"application_product": "application_details.vendor_product"}).first().application_product == "own product"
    with pytest.raises(ValueError):
        silver.flatten_payment(raw, paths={"no_column": "id"})
    header = dict(zip(["m", "c", "VendorItemID", "VendorVariationID"], menu.MAPPING_COLUMNS.values(), strict=True))
    mapping = spark.createDataFrame([(" 1", "2 ", " i ", "v")], "m string, c string, VendorItemID string, VendorVariationID string")
    assert tuple(menu.trim_mapping(mapping, header).first()) == ("1", "2", "i", "v")
    with pytest.raises(ValueError):
        menu.trim_mapping(mapping, {"m": "business_menu_id"})
