"""Queries over flattening, schema-driven reshaping and projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starledger.functions import scalars
from starledger.operators import reshape
from starledger.plans import menu, silver
from starledger.sources.readers import scan_csv
from starledger.workload.oracle import AMOUNT, padded
from starledger.workload.registry import Context, query
from starledger.workload.roles import cents, every, padded as padded_column


@query("explode_records", f"SELECT {padded('S', 'o_orderkey')} AS order_id, o_orderkey % 7 AS version FROM orders")
def explode_records(c: Context) -> DataFrame:
    return reshape.explode_records(c.narrow("orders", "orders", ["id", "version"]), "orders").select(
        F.col("record.id").alias("order_id"), F.col("record.version").alias("version")
    )


def _line_ids(c: Context, outer: bool) -> DataFrame:
    orders = reshape.explode_records(c.narrow("order_lines", "orders", ["id", "location_id", "line_items"]), "orders")
    keys = {"order_id": F.col("record.id"), "location_id": F.col("record.location_id")}
    lines = reshape.explode_children(orders, keys, "record.line_items", outer=outer)
    return lines.select(*keys, F.col("child.uid").alias("order_line_id"))


@query("explode_outer_children", "SELECT order_id, location_id, order_line_id FROM o_line")
def explode_outer_children(c: Context) -> DataFrame:
    return _line_ids(c, outer=True)


@query(
    "explode_inner_children",
    "SELECT order_id, location_id, order_line_id FROM o_line WHERE order_line_id IS NOT NULL",
)
def explode_inner_children(c: Context) -> DataFrame:
    return _line_ids(c, outer=False)


_ITEM = [f"item_data.{f}" for f in ("name", "description", "product_type", "is_taxable", "categories", "variations")]


def _nested_items(c: Context) -> DataFrame:
    """Items with their nested variations, under a schema of only what is read of them."""
    return c.narrow("nested_items", "objects", ["type", "id", *_ITEM])


@query("item_variation_outer", "SELECT * FROM o_nested")
def item_variation_outer(c: Context) -> DataFrame:
    return silver.flatten_item_variations(_nested_items(c))


@query(
    "item_variation_inner",
    """SELECT * REPLACE (CASE WHEN is_taxable IS NULL THEN 'None' WHEN is_taxable THEN 'True' ELSE 'False' END
    AS is_taxable) FROM o_nested WHERE variation_id IS NOT NULL""",
)
def item_variation_inner(c: Context) -> DataFrame:
    return silver.flatten_item_variations(_nested_items(c), outer=False)


for _name, _layer in {
    "flatten_order_header": "order_header:o_header",
    "flatten_order_line": "order_line:o_line",
    "flatten_order_tender": "order_tender:o_tender",
    "flatten_payment": "payment:o_payment",
    "flatten_customer": "customer:o_customer",
    "flatten_catalog_item": "catalog_item:o_item",
    "flatten_catalog_variation": "catalog_variation:o_variation",
    "flatten_inventory": "inventory:o_inventory",
    "flatten_employee": "employee:o_employee",
}.items():
    _table, _oracle = _layer.split(":")
    query(_name, f"SELECT * FROM {_oracle}")(lambda c, t=_table: c.star.compute(t))


@query("flatten_location", "SELECT * FROM o_location_all")
def flatten_location(c: Context) -> DataFrame:
    return silver.flatten_location(c.raw("locations"))


@query("flatten_location_detail", "SELECT * FROM o_location_detail")
def flatten_location_detail(c: Context) -> DataFrame:
    return silver.flatten_location(c.raw("locations"), detail=True)


@query("flatten_payment_detail", "SELECT * FROM o_payment_detail")
def flatten_payment_detail(c: Context) -> DataFrame:
    return silver.flatten_payment(c.narrow("payments", "payments", [p for _, p, _ in silver.PAYMENT_DETAIL]), detail=True)


@query(
    "flatten_processing_fee",
    f"""SELECT {padded('P', 'o_orderkey')} AS payment_id, o_orderdate + INTERVAL 3 DAY AS processing_fee_effective_at,
    'INITIAL' AS processing_fee_type, {AMOUNT} * 2 // 100 AS processing_fee_amount, 'USD' AS processing_fee_currency
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT {padded('P', 'o_orderkey')}, o_orderdate + INTERVAL 9 DAY, 'ADJUSTMENT', CAST(-30 AS BIGINT), 'USD'
    FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000""",
)
def flatten_processing_fee(c: Context) -> DataFrame:
    return silver.flatten_processing_fee(c.narrow("payments", "payments", ["id", "processing_fee"]))


@query("flatten_category", "SELECT * FROM o_category")
def flatten_category(c: Context) -> DataFrame:
    return silver.flatten_category(c.narrow("catalog", "objects", ["type"] + [p for _, p, _ in silver.CATEGORY]))


@query(
    "flatten_customer_detail",
    f"""SELECT o.*, CASE WHEN c_custkey % 4 = 0 THEN {padded('Company ', '(c_custkey % 50)', 2)} END AS company_name,
    CASE WHEN c_custkey % 10 = 0 THEN 'calls from ' || c_mktsegment END AS note, {padded('Road ', 'c_custkey', 5)} AS address_line_1,
    CASE WHEN c_custkey % 3 = 0 THEN {padded('Flat ', '(c_custkey % 9)', 1)} END AS address_line_2
    FROM o_customer o JOIN customer ON customer_id = {padded('C', 'c_custkey')}""",
)
def flatten_customer_detail(c: Context) -> DataFrame:
    return silver.flatten_customer(c.raw("customers"), detail=True)


@query(
    "flatten_inventory_decimal",
    """SELECT variation_id, inventory_state, calculated_at, CAST(CASE WHEN quantity IS NULL THEN NULL
    WHEN quantity < 0 THEN quantity - 0.5 ELSE quantity + 0.5 END AS DECIMAL(18,3)) AS quantity FROM o_inventory""",
)
def flatten_inventory_decimal(c: Context) -> DataFrame:
    """Fractional quantities, as the decimal form keeps them."""
    flat = silver.flatten_inventory(c.raw("inventory"), "decimal(18,3)")
    return flat.select("variation_id", "inventory_state", "calculated_at", "quantity")


@query(
    "safe_col",
    """SELECT o_orderkey, o_orderstatus AS state, CAST(NULL AS VARCHAR) AS nickname,
    CAST(o_totalprice AS DECIMAL(18,3)) AS price, CAST(NULL AS BIGINT) AS points FROM orders""",
)
def safe_col(c: Context) -> DataFrame:
    """Present and absent paths of a nested column."""
    nested = c.table("orders").select("o_orderkey", F.struct("o_orderstatus", "o_totalprice").alias("o"))
    return nested.select(
        "o_orderkey",
        reshape.safe_col(nested.schema, "o.o_orderstatus", "state"),
        reshape.safe_col(nested.schema, "o.nickname", "nickname"),
        reshape.safe_col(nested.schema, "o.o_totalprice", "price", "decimal(18,3)"),
        reshape.safe_col(nested.schema, "o.loyalty.points", "points", "bigint"),
    )


@query(
    "first_element",
    "SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS segment_id FROM customer",
)
def first_element(c: Context) -> DataFrame:
    """The first segment; NULL where the array is empty."""
    segments = F.when(every("c_custkey", 9), F.array().cast("array<string>")).otherwise(
        F.array("c_mktsegment", F.lit("ALL"))
    )
    return c.table("customer").select("c_custkey", scalars.first_element(segments).alias("segment_id"))


@query("first_or_default", "SELECT DISTINCT item_id, category_id FROM o_nested")
def first_or_default(c: Context) -> DataFrame:
    items = reshape.explode_records(c.narrow("nested_items", "objects", ["id", "item_data.categories"]), "objects")
    category = scalars.first_or_default(F.col("record.item_data.categories"), "id")
    return items.select(F.col("record.id").alias("item_id"), category.alias("category_id"))


@query(
    "first_truthy",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN c_mktsegment ELSE c_name END AS label
    FROM customer""",
)
def first_truthy(c: Context) -> DataFrame:
    """A name that is missing on some rows and empty on others, or else the segment."""
    name = F.when(every("c_custkey", 3), None).when(every("c_custkey", 5), "").otherwise(F.col("c_name"))
    return c.table("customer").select("c_custkey", scalars.first_truthy(name, F.col("c_mktsegment")).alias("label"))


@query(
    "bool_to_text",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'None' WHEN 'F' THEN 'True' ELSE 'False' END AS is_final
    FROM orders""",
)
def bool_to_text(c: Context) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    return c.table("orders").select("o_orderkey", scalars.bool_text(flag).alias("is_final"))


def _nested_lines(c: Context) -> DataFrame:
    return c.table("lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.struct(
            F.col("l_partkey").alias("id"),
            F.struct(cents("l_extendedprice").alias("amount"), F.lit("USD").alias("currency")).alias("price"),
        ).alias("part"),
        F.struct(F.col("l_shipdate").alias("at"), F.col("l_returnflag").alias("flag")).alias("shipped"),
        F.col("l_linenumber").alias("line"),
    )


@query(
    "flatten_structs",
    """SELECT l_orderkey AS id, l_linenumber AS line, l_shipdate AS shipped_at, l_returnflag AS shipped_flag,
    l_partkey AS part_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS part_price_amount,
    'USD' AS part_price_currency FROM lineitem""",
)
def flatten_structs(c: Context) -> DataFrame:
    return reshape.flatten_structs(_nested_lines(c))


def _with_arrays(c: Context) -> DataFrame:
    """Two arrays per order: of text and of structs; one of them empty or missing on some."""
    tags = F.when(every("o_orderkey", 4), F.array().cast("array<string>")).otherwise(
        F.array("o_orderstatus", "o_orderpriority")
    )
    amounts = F.when(
        ~every("o_orderkey", 5),
        F.array(
            F.struct(F.lit("total").alias("kind"), cents("o_totalprice").alias("amount")),
            F.struct(F.lit("none").alias("kind"), F.lit(0).cast("bigint").alias("amount")),
        ),
    )
    return c.table("orders").select("o_orderkey", tags.alias("tags"), amounts.alias("amounts"))


_TAGS = """tags AS (SELECT o_orderkey, o_orderstatus AS tags FROM orders WHERE o_orderkey % 4 <> 0
  UNION ALL SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 4 <> 0)"""
_AMOUNTS = f"""amounts AS (SELECT o_orderkey, 'total' AS kind, {AMOUNT} AS amount FROM orders WHERE o_orderkey % 5 <> 0
  UNION ALL SELECT o_orderkey, 'none', 0 FROM orders WHERE o_orderkey % 5 <> 0)"""


@query(
    "explode_arrays",
    f"""WITH {_TAGS}, {_AMOUNTS}
    SELECT o.o_orderkey, t.tags, a.kind AS amounts_kind, a.amount AS amounts_amount FROM orders o
    LEFT JOIN tags t ON o.o_orderkey = t.o_orderkey LEFT JOIN amounts a ON o.o_orderkey = a.o_orderkey""",
)
def explode_arrays(c: Context) -> DataFrame:
    return reshape.explode_arrays(_with_arrays(c))


@query(
    "array_columns",
    f"""WITH {_TAGS}, {_AMOUNTS} SELECT 'tags' AS column_name, 'array<string>' AS column_type, count(*) AS elements
    FROM tags UNION ALL SELECT 'amounts', 'array<struct<kind:string,amount:bigint>>', count(*) FROM amounts""",
)
def array_columns(c: Context) -> DataFrame:
    """The array columns found in a schema, with the elements each holds."""
    df = _with_arrays(c)
    found = reshape.array_columns(df)
    sizes = df.agg(*[F.coalesce(F.sum(F.size(name)), F.lit(0)).alias(name) for name, _ in found])
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("column_type"), F.col(n).alias("elements"))
            for n, t in found
        ]
    )
    return sizes.select(F.explode(rows).alias("found")).select("found.*")


def _texts(c: Context) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return c.table("orders").select(
        "o_orderkey",
        text.alias("Created_At"),
        F.when(every("o_orderkey", 3), "unknown").otherwise(text).alias("line_sold_at"),
        text.alias("note"),
    )


@query(
    "timestamps_by_keyword",
    """SELECT o_orderkey, o_orderdate AS "Created_At", CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS line_sold_at,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS note FROM orders""",
)
def timestamps_by_keyword(c: Context) -> DataFrame:
    return reshape.parse_timestamps(_texts(c))


@query(
    "timestamps_by_list",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "Created_At",
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS line_sold_at, o_orderdate AS note FROM orders""",
)
def timestamps_by_list(c: Context) -> DataFrame:
    return reshape.parse_timestamps(_texts(c), names=["line_sold_at", "note"])


@query(
    "drop_all_null_columns",
    """SELECT location_id, location_name, business_name, location_status, location_type, address_line_1, city, state,
    postal_code, country, timezone, currency, language_code, created_at, ingested_at, updated_at FROM o_location_all""",
)
def drop_all_null_columns(c: Context) -> DataFrame:
    """No location has a second address line or an update time; the latter is required and stays."""
    return reshape.drop_all_null_columns(silver.flatten_location(c.raw("locations")), required=["updated_at"])


@query("key_first", "SELECT * FROM lineitem")
def key_first(c: Context) -> DataFrame:
    return reshape.key_first(c.table("lineitem"), "l_shipdate")


@query("reorder_columns", "SELECT s_nationkey, s_name, s_suppkey FROM supplier")
def reorder_columns(c: Context) -> DataFrame:
    return reshape.reorder_columns(c.table("supplier"), ["s_nationkey", "s_name", "s_suppkey"])


@query("rename_map", "SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal FROM customer")
def rename_map(c: Context) -> DataFrame:
    df = c.table("customer").select("c_custkey", "c_name", "c_acctbal")
    return reshape.rename_columns(df, {"c_custkey": "customer_key", "c_name": "customer_name"})


def mapping_file(c: Context) -> DataFrame:
    """A mapping file with blanks around its ids; it knows some variations by another id and lists some twice."""
    known = F.when(every("p_partkey", 6), padded_column("U", "p_partkey")).otherwise(padded_column("V", "p_partkey"))
    rows = c.table("part").select(
        F.concat(F.lit("  M"), F.col("p_partkey").cast("string"), F.lit(" ")).alias("BusinessMenuID"),
        F.concat(F.lit(" "), F.col("p_type")).alias("BusinessCategoryID"),
        F.concat(padded_column("N", "p_partkey"), F.lit(" ")).alias("ItemID"),
        F.concat(F.lit(" "), known).alias("VariationID"),
    )
    rows = rows.unionAll(rows.filter(F.col("BusinessCategoryID") == " SMALL"))
    path = c.scratch("mapping-csv")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(header=True, **keep).csv(path)
    return scan_csv(c.spark, path)


_MAPPING = f"""mapping AS (SELECT 'M' || p_partkey AS business_menu_id, p_type AS business_category_id,
  {padded('N', 'p_partkey')} AS mapping_item_id,
  CASE WHEN p_partkey % 6 = 0 THEN {padded('U', 'p_partkey')} ELSE {padded('V', 'p_partkey')} END AS mapping_variation_id
  FROM part, (VALUES (1), (2)) AS copies(n) WHERE n = 1 OR p_type = 'SMALL')"""
_JOINED = f"""{_MAPPING}, joined AS (SELECT * FROM o_nested n LEFT JOIN mapping m
  ON n.item_id = m.mapping_item_id AND n.variation_id = m.mapping_variation_id)"""


def _joined_menu(c: Context) -> DataFrame:
    variations = silver.flatten_item_variations(_nested_items(c))
    return menu.join_menu_mapping(variations, menu.trim_mapping(mapping_file(c)))


@query("trim_mapping", f"WITH {_MAPPING} SELECT * FROM mapping")
def trim_mapping(c: Context) -> DataFrame:
    return menu.trim_mapping(mapping_file(c))


@query("menu_mapping_join", f"WITH {_JOINED} SELECT * FROM joined")
def menu_mapping_join(c: Context) -> DataFrame:
    return _joined_menu(c)


@query("final_menu", f"WITH {_JOINED} SELECT {', '.join(menu.MENU_COLUMNS)} FROM joined")
def final_menu(c: Context) -> DataFrame:
    return menu.final_menu(_joined_menu(c))


@query(
    "menu_gaps",
    f"""WITH {_JOINED} SELECT count(*) AS total_rows,
    count(*) FILTER (business_menu_id IS NULL) AS null_business_menu_id,
    count(*) FILTER (business_category_id IS NULL) AS null_business_category_id,
    count(*) FILTER (category_id IS NULL) AS null_category_id,
    count(*) FILTER (item_id IS NULL) AS null_item_id,
    count(*) FILTER (variation_id IS NULL) AS null_variation_id FROM joined""",
)
def menu_gaps(c: Context) -> DataFrame:
    return menu.menu_gaps(_joined_menu(c))


@query(
    "menu_duplicates",
    f"""WITH {_JOINED} SELECT count(*) AS duplicate_keys FROM (SELECT business_menu_id, variation_id FROM joined
    GROUP BY ALL HAVING count(*) > 1)""",
)
def menu_duplicates(c: Context) -> DataFrame:
    return menu.menu_duplicates(_joined_menu(c))


@query(
    "array_length",
    """SELECT array_length, count(*) AS envelopes FROM (
    SELECT CASE WHEN l_discount >= 0.09 THEN 2 ELSE 1 END AS array_length FROM lineitem
    UNION ALL SELECT 0 FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 97 = 0
    UNION ALL SELECT NULL FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 89 = 0) GROUP BY 1""",
)
def array_length(c: Context) -> DataFrame:
    """Lengths of the line arrays, how often each occurs; a missing array has none."""
    lines = reshape.explode_records(c.narrow("order_lines", "orders", ["line_items"]), "orders").select("record.line_items")
    return reshape.array_sizes(lines, "line_items").groupBy("array_length").agg(F.count("*").alias("envelopes"))


@query(
    "sample_record",
    """SELECT '{' || chr(10) || '  "o_orderkey" : ' || o_orderkey || ',' || chr(10) || '  "o_orderstatus" : "' ||
    o_orderstatus || '"' || chr(10) || '}' AS record_json FROM orders ORDER BY o_orderkey LIMIT 1""",
)
def sample_record(c: Context) -> DataFrame:
    return reshape.sample_record(c.table("orders").select("o_orderkey", "o_orderstatus").orderBy("o_orderkey"))
