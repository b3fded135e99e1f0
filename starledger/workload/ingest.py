"""Queries over sources, sinks and raw snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window, functions as F, types as T

from starledger.operators.reshape import explode_records, project
from starledger.plans.silver import CUSTOMER, flatten_location
from starledger.sources import bronze, pages, readers, tables
from starledger.sources.schemas import CUSTOMER as CUSTOMER_TYPE
from starledger.sources.schemas import envelope, record_type
from starledger.workload.oracle import AMOUNT, padded
from starledger.workload.registry import Context, query
from starledger.workload.roles import cents, every

_CUSTOMER_COLUMNS = ", ".join(name for name, _, _ in CUSTOMER)


@query("scan_json_multiline", "SELECT * FROM o_location_all")
def scan_json_multiline(c: Context) -> DataFrame:
    """Locations written as indented JSON, one envelope per file, and read back."""
    path = c.scratch("locations")
    pretty = F.to_json(F.struct("*"), {"pretty": "true"}).alias("value")
    c.raw("locations").select(pretty).write.option("maxRecordsPerFile", 1).text(path)
    return flatten_location(readers.scan_json(c.spark, path, envelope("locations")))


_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@query(
    "list_source_files",
    " UNION ALL ".join(f"SELECT '{t}.parquet' AS source_name, count(*) AS row_count FROM {t}" for t in _TABLES),
)
def list_source_files(c: Context) -> DataFrame:
    """The files behind the tables with their rows, per table."""
    listed = [
        readers.source_files(c.spark, f"{c.sf_dir}/{t}.parquet", c.table(t)).withColumn("source_name", F.lit(f"{t}.parquet"))
        for t in _TABLES
    ]
    stacked = listed[0]
    for one in listed[1:]:
        stacked = stacked.unionAll(one)
    return stacked.groupBy("source_name").agg(F.sum("row_count").alias("row_count"))


@query(
    "scan_csv",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS p_retailprice FROM part""",
)
def scan_csv(c: Context) -> DataFrame:
    path = c.scratch("part-csv")
    part = c.table("part").withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(12,2)"))
    part.write.option("header", True).csv(path)
    return readers.scan_csv(c.spark, path)


@query("scan_table", "SELECT * FROM orders")
def scan_table(c: Context) -> DataFrame:
    path = c.scratch("orders-table")
    tables.write_table(c.table("orders"), path)
    return readers.scan_table(c.spark, path)


@query("rows_to_df_schema", f"SELECT {_CUSTOMER_COLUMNS} FROM o_customer")
def rows_to_df_schema(c: Context) -> DataFrame:
    """Customer records as JSON text, typed by their schema, on top of an empty frame of that schema."""
    text = explode_records(c.raw("customers"), "customers").select(F.to_json("record").alias("body"))
    typed = readers.typed_rows(text, "body", record_type("customers"))
    typed = readers.empty_rows(c.spark, typed.schema).unionByName(typed)
    return project(typed.select(F.struct("*").alias("record")), "record", CUSTOMER)


@query(
    "rows_to_df_inferred",
    """SELECT CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k, count(*) AS row_count FROM events GROUP BY 1""",
)
def rows_to_df_inferred(c: Context) -> DataFrame:
    """Event properties as lines of JSON, read under the schema found in them."""
    path = c.scratch("props")
    c.table("events").select("props").write.text(path)
    return readers.scan_json_inferred(c.spark, path).groupBy("k").agg(F.count("*").alias("row_count"))


_PAGE_RECORD = "struct<id:string,amount:bigint>"


def _pages(c: Context) -> DataFrame:
    """One page per order in chains of 1,000: no array on some, two records on others, a few pages after the last."""
    orders = c.table("orders")
    one = F.struct(F.col("o_orderkey").cast("string").alias("id"), cents("o_totalprice").alias("amount"))
    two = F.struct(F.concat(F.col("o_orderkey").cast("string"), F.lit("b")).alias("id"), F.lit(7).alias("amount"))
    records = F.when(every("o_orderkey", 7), None).when(every("o_orderkey", 3), F.array(one, two)).otherwise(F.array(one))
    cursor = F.when(~every("o_orderkey", 1000, 989), F.concat(F.lit("after-"), F.col("o_orderkey").cast("string")))
    body = F.to_json(F.struct(cursor.alias("cursor"), records.alias("records")))
    chain = F.floor(F.col("o_orderkey") / 1000).alias("chain")
    return orders.select(chain, F.col("o_orderkey").alias("page_no"), body.alias("body"))


_CHAIN = f"""WITH ends AS (SELECT o_orderkey // 1000 AS c, min(o_orderkey) AS last FROM orders
  WHERE o_orderkey % 1000 = 989 GROUP BY 1),
  chain AS (SELECT o.*, {AMOUNT} AS amount, o_orderkey // 1000 AS c FROM orders o LEFT JOIN ends e
  ON o_orderkey // 1000 = e.c WHERE e.last IS NULL OR o_orderkey <= e.last)"""


@query(
    "merge_pages",
    f"""{_CHAIN}
    SELECT o_orderkey AS page_no, 0 AS position, CAST(o_orderkey AS VARCHAR) AS id, amount FROM chain
    WHERE o_orderkey % 7 <> 0
    UNION ALL SELECT o_orderkey, 1, o_orderkey || 'b', 7 FROM chain WHERE o_orderkey % 7 <> 0 AND o_orderkey % 3 = 0""",
)
def merge_pages(c: Context) -> DataFrame:
    merged = pages.merge_pages(_pages(c), "records", _PAGE_RECORD, ["chain"])
    return merged.select("page_no", "position", "record.*")


@query(
    "merge_pages_report",
    f"""{_CHAIN}
    SELECT c AS chain, count(*) AS pages, CAST(sum(CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END)
    AS BIGINT) AS records FROM chain GROUP BY c""",
)
def merge_pages_report(c: Context) -> DataFrame:
    return pages.page_report(_pages(c), "records", _PAGE_RECORD, ["chain"])


def _cursor_pages(c: Context) -> DataFrame:
    """The pages of :func:`_pages` without numbers: each knows the cursor it was asked for with.

    Every fifth chain lacks page 500, every fifth has page 700 point back to page 100; every fiftieth page comes twice.
    """
    pages, kind = _pages(c), F.col("chain") % 5
    before = F.lag("page_no").over(Window.partitionBy("chain").orderBy("page_no"))
    asked = pages.withColumn("asked", F.concat(F.lit("after-"), before.cast("string")))
    asked = asked.filter(~((kind == 3) & (F.col("page_no") % 1000 == 500)))
    back = F.regexp_replace("body", "after-[0-9]+", F.concat(F.lit("after-"), (F.col("page_no") - 601).cast("string")))
    turned = asked.withColumn("body", F.when((kind == 4) & (F.col("page_no") % 1000 == 700), back).otherwise(F.col("body")))
    again = turned.filter(every("page_no", 50))
    return turned.unionAll(again).select("chain", "asked", "body")


_CURSOR_CHAIN = f"""WITH placed AS (SELECT *, o_orderkey // 1000 AS c, o_orderkey % 1000 AS k, {AMOUNT} AS amount FROM orders),
  chain AS (SELECT * FROM placed WHERE k <= 989 AND NOT (c % 5 = 3 AND k >= 500) AND NOT (c % 5 = 4 AND k > 700))"""


@query(
    "merge_pages_by_cursor",
    f"""{_CURSOR_CHAIN}
    SELECT dense_rank() OVER (PARTITION BY c ORDER BY o_orderkey) AS page_no, position, id, r.amount AS amount FROM chain LEFT JOIN LATERAL (
      SELECT 0 AS position, CAST(o_orderkey AS VARCHAR) AS id, amount WHERE o_orderkey % 7 <> 0
      UNION ALL SELECT 1, o_orderkey || 'b', 7 WHERE o_orderkey % 7 <> 0 AND o_orderkey % 3 = 0) r ON true
    QUALIFY id IS NOT NULL""",
)
def merge_pages_by_cursor(c: Context) -> DataFrame:
    """Records of pages that only their cursors put in order."""
    linked = pages.link_pages(_cursor_pages(c), ["chain"])
    return pages.merge_linked_pages(linked, "records", _PAGE_RECORD, ["chain"]).select("page_no", "position", "record.*")


@query(
    "cursor_report",
    f"""{_CURSOR_CHAIN}, given AS (SELECT * FROM placed WHERE NOT (c % 5 = 3 AND k = 500)),
    ends AS (SELECT c, max(k) AS k, count(*) AS pages, CAST(sum(CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END)
      AS BIGINT) AS records FROM chain GROUP BY c),
    totals AS (SELECT c, count(*) AS n, CAST(count(*) FILTER (o_orderkey % 50 = 0) AS BIGINT) AS again FROM given GROUP BY c)
    SELECT c AS chain, pages, records, n - pages AS unreached, again AS repeated,
    CASE WHEN k = 989 THEN 'complete' WHEN c % 5 = 4 AND k = 700 THEN 'loop' ELSE 'gap' END AS ends,
    CASE WHEN k <> 989 AND NOT (c % 5 = 4 AND k = 700) THEN 'after-' || (c * 1000 + k) END AS missing
    FROM ends JOIN totals USING (c)""",
)
def cursor_report(c: Context) -> DataFrame:
    """Gaps, loops and repeated deliveries found in chains of pages."""
    return pages.link_report(pages.link_pages(_cursor_pages(c), ["chain"]), "records", _PAGE_RECORD, ["chain"])


_SNAPSHOTS = ("20260820_000000", "20260821_000000")


@query(
    "bronze_envelope_write",
    " UNION ALL ".join(
        f"""SELECT '{s}' AS ingested_at, 'customers service' AS source, 'L0001' AS location_id, customer_id, given_name,
        address_locality FROM o_customer"""
        for s in _SNAPSHOTS
    ),
)
def bronze_envelope_write(c: Context) -> DataFrame:
    """Two snapshots of all customers, written and read back."""
    path = c.scratch("bronze-customers")
    records = explode_records(c.raw("customers"), "customers")
    for at in (*_SNAPSHOTS, _SNAPSHOTS[-1]):  # the last one is delivered twice
        bronze.write_bronze(records, path, "customers service", at, "L0001")
    schema = T.StructType().add("record", record_type("customers"))
    return bronze.read_bronze(c.spark, path, schema).select(
        "ingested_at",
        "source",
        "location_id",
        F.col("record.id").alias("customer_id"),
        F.col("record.given_name").alias("given_name"),
        F.col("record.address.locality").alias("address_locality"),
    )


@query(
    "bronze_manifest",
    """SELECT '20260820_000000' AS ingested_at, 'orders service' AS source, CAST(NULL AS VARCHAR) AS location_id,
    count(*) AS record_count FROM orders""",
)
def bronze_manifest(c: Context) -> DataFrame:
    records = explode_records(c.raw("orders"), "orders")
    return bronze.write_bronze(records, c.scratch("bronze-orders"), "orders service", _SNAPSHOTS[0])


@query(
    "bronze_flat_records",
    f"""SELECT '20260820_000000' AS ingested_at, 'orders service' AS source, 'L0001' AS location_id,
    {padded('S', 'o_orderkey')} AS order_id, o_orderpriority AS own_source,
    {padded('L', '(o_custkey % 27)', 4)} AS own_location_id FROM orders""",
)
def bronze_flat_records(c: Context) -> DataFrame:
    """Flat orders that have a source and a location of their own beside those of the snapshot."""
    path = c.scratch("bronze-flat")
    wanted = ["id", "location_id", "source.name"]
    record = explode_records(c.narrow("orders", "orders", wanted), "orders")
    flat = record.select("record.id", F.col("record.source.name").alias("source"), "record.location_id")
    bronze.write_bronze(flat, path, "orders service", _SNAPSHOTS[0], "L0001")
    own = F.col("record")
    return bronze.read_bronze(c.spark, path, T.StructType().add("record", flat.schema)).select(
        "ingested_at", "source", "location_id", own["id"].alias("order_id"), own["source"].alias("own_source"), own["location_id"].alias("own_location_id"),
    )


@query(
    "scan_json_bad_records",
    "SELECT count(*) AS records, CAST(count(CASE WHEN o_orderkey % 50 = 0 THEN 1 END) AS BIGINT) AS bad_records FROM orders",
)
def scan_json_bad_records(c: Context) -> DataFrame:
    """Records counted with those that cannot be read."""
    path = c.scratch("bad-records")
    body = F.to_json(F.struct(F.col("o_orderkey").alias("id"), "o_orderstatus"))
    c.table("orders").select(F.when(every("o_orderkey", 50), F.substring(body, 1, 7)).otherwise(body).alias("value")).write.text(path)
    return readers.bad_records(readers.scan_json_lines(c.spark, path, "id bigint, o_orderstatus string", bad="bad"), "bad")


@query("bronze_fixed_write", "SELECT customer_id, email_address FROM o_customer")
def bronze_fixed_write(c: Context) -> DataFrame:
    """A snapshot replaced by the next one."""
    path = c.scratch("fixed-customers")
    records = explode_records(c.raw("customers"), "customers")
    for _ in range(2):
        bronze.write_fixed(records, path)
    read = readers.scan_json_lines(c.spark, path, f"record {CUSTOMER_TYPE}")
    return read.select(F.col("record.id").alias("customer_id"), F.col("record.email_address").alias("email_address"))


_REQUEST = ["type", "id", "item_variation_data.item_id", "item_variation_data.sku"]


@query(
    "inventory_request_keys", "SELECT variation_id AS catalog_object_id, item_id, sku FROM o_variation"
)
def inventory_request_keys(c: Context) -> DataFrame:
    return bronze.inventory_request_keys(explode_records(c.narrow("catalog", "objects", _REQUEST), "objects"))


@query(
    "inventory_request_key_counts",
    """SELECT count(*) AS total_variations, count(DISTINCT variation_id) AS unique_variations FROM o_variation""",
)
def inventory_request_key_counts(c: Context) -> DataFrame:
    return bronze.request_key_counts(bronze.inventory_request_keys(explode_records(c.narrow("catalog", "objects", _REQUEST), "objects")))


@query("table_overwrite", "SELECT s_suppkey, s_name FROM supplier")
def table_overwrite(c: Context) -> DataFrame:
    """A table replaced by rows of another schema."""
    path = c.scratch("supplier-table")
    tables.write_table(c.table("supplier"), path)
    tables.write_table(c.table("supplier").select("s_suppkey", "s_name"), path)
    return readers.scan_table(c.spark, path)


@query("table_overwrite_strict", "SELECT * FROM supplier WHERE s_acctbal > 0")
def table_overwrite_strict(c: Context) -> DataFrame:
    """A table replaced by rows of the same schema, after rows of another one were turned away."""
    path = c.scratch("supplier-strict")
    supplier = c.table("supplier")
    tables.write_table(supplier, path, evolve_schema=False)
    try:
        tables.write_table(supplier.select("s_name"), path, evolve_schema=False)
    except ValueError:
        tables.write_table(supplier.filter(F.col("s_acctbal") > 0), path, evolve_schema=False)
    return readers.scan_table(c.spark, path)


@query("skip_write_if_empty", "SELECT * FROM customer")
def skip_write_if_empty(c: Context) -> DataFrame:
    """A table kept as it is when nothing comes to replace it."""
    path = c.scratch("customer-kept")
    customer = c.table("customer")
    tables.write_table(customer, path, skip_empty=True)
    tables.write_table(customer.filter(F.col("c_custkey") < 0), path, skip_empty=True)
    return readers.scan_table(c.spark, path)


@query(
    "rows_to_df_bad",
    """SELECT count(*) AS records, CAST(count(*) FILTER (o_orderkey % 40 = 0) AS BIGINT) AS bad_records,
    CAST(sum(o_orderkey) FILTER (o_orderkey % 40 <> 0) AS BIGINT) AS id_sum FROM orders""",
)
def rows_to_df_bad(c: Context) -> DataFrame:
    """Order records as text, some of them cut off, typed with the text that cannot be read kept beside."""
    body = F.to_json(F.struct(F.col("o_orderkey").alias("id"), "o_orderstatus"))
    text = c.table("orders").select(F.when(every("o_orderkey", 40), F.substring(body, 1, 9)).otherwise(body).alias("body"))
    typed = readers.typed_rows(text, "body", "id bigint, o_orderstatus string", bad="unread")
    return typed.agg(
        F.count("*").alias("records"), F.count("unread").alias("bad_records"), F.sum(F.when(F.col("unread").isNull(), F.col("id"))).alias("id_sum")
    )


@query(
    "scan_json_merged",
    """SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE CAST(o_totalprice AS DOUBLE) END AS amount,
    CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN o_orderstatus END AS code,
    CASE WHEN o_orderkey % 4 = 2 THEN o_custkey > 50 END AS flag,
    CASE o_orderkey % 4 WHEN 1 THEN o_custkey END AS customer_id, CASE o_orderkey % 4 WHEN 2 THEN o_orderpriority END AS customer_note,
    CAST(CASE o_orderkey % 4 WHEN 0 THEN 1.0 WHEN 3 THEN 0.5 END AS DOUBLE) AS first_weight FROM
    (SELECT * REPLACE (CASE WHEN o_orderkey % 4 = 0 THEN CAST(trunc(o_totalprice) AS BIGINT) ELSE trunc(o_totalprice) + 0.25 END AS o_totalprice) FROM orders)""",
)
def scan_json_merged(c: Context) -> DataFrame:
    """Files whose fields and kinds drift, read under the one schema that holds all of them."""
    path, orders, part = c.scratch("drift"), c.table("orders"), F.col("o_orderkey") % 4
    whole = F.floor("o_totalprice")
    exact = F.col("o_totalprice").cast("bigint") + F.lit(0.25).cast("decimal(3,2)")
    versions = {
        0: [whole.cast("bigint").alias("amount"), F.col("o_custkey").alias("code"), F.array(F.lit(1)).alias("weights")],
        1: [exact.alias("amount"), F.col("o_orderstatus").alias("code"), F.struct(F.col("o_custkey").alias("id")).alias("customer")],
        2: [exact.alias("amount"), (F.col("o_custkey") > 50).alias("flag"), F.struct(F.col("o_orderpriority").alias("note")).alias("customer")],
        3: [F.lit(None).cast("string").alias("amount"), F.array(F.lit(0.5)).alias("weights")],
    }
    for n, columns in versions.items():
        body = F.to_json(F.struct(F.col("o_orderkey").alias("id"), *columns), {"ignoreNullFields": "false"})
        orders.filter(part == n).select(body.alias("value")).write.text(f"{path}/{n}")
    read = readers.scan_json_merged(c.spark, path)
    return read.select("id", "amount", "code", "flag", F.col("customer.id").alias("customer_id"), F.col("customer.note").alias("customer_note"), F.get("weights", F.lit(0)).alias("first_weight"))


@query(
    "file_schemas",
    """SELECT o_orderkey % 3 AS version, count(*) AS records, CAST(count(*) FILTER (o_orderkey % 30 = 0) AS BIGINT) AS bad_records,
    CASE o_orderkey % 3 WHEN 0 THEN 'OBJECT<id: BIGINT>' WHEN 1 THEN 'OBJECT<id: BIGINT, note: STRING>' ELSE 'OBJECT<id: STRING>' END AS found
    FROM orders GROUP BY 1, 4""",
)
def file_schemas(c: Context) -> DataFrame:
    """What each of several files holds by itself."""
    path, orders = c.scratch("kinds"), c.table("orders")
    versions = (F.struct(F.col("o_orderkey").alias("id")), F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("note")), F.struct(F.col("o_orderkey").cast("string").alias("id")))
    for n, record in enumerate(versions):
        body = F.to_json(record)
        text = F.when(every("o_orderkey", 30), F.substring(body, 1, 4)).otherwise(body)
        orders.filter(F.col("o_orderkey") % 3 == n).select(text.alias("value")).coalesce(1).write.text(f"{path}/version-{n}")
    version = F.regexp_extract("file_path", "version-([0-9])", 1).cast("bigint").alias("version")
    return readers.file_schemas(c.spark, path).select(version, "records", "bad_records", "found")


@query(
    "stored_bounds",
    """SELECT count(*) AS row_count, min(date_key) AS min_date_key, max(date_key) AS max_date_key,
    min(inventory_date) AS min_inventory_date, max(inventory_date) AS max_inventory_date FROM f_inventory WHERE date_month IS NOT NULL""",
)
def stored_bounds(c: Context) -> DataFrame:
    """Dated rows and bounds of a stored fact, answered by the footers of its files."""
    dated = F.col("date_month").isNotNull()
    return readers.stored_bounds(c.spark, c.star.path("fact_inventory"), ["date_key", "inventory_date"], dated)


@query("catalog_table_overwrite", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def catalog_table_overwrite(c: Context) -> DataFrame:
    """A table of the catalog replaced; a write that fails between leaves it as it is."""
    name = f"supplier_{uuid.uuid4().hex}"
    supplier = c.table("supplier")
    tables.write_table(supplier, name)
    tables.write_table(supplier.filter(F.col("s_acctbal") > 0).select("s_suppkey", "s_name"), name)
    try:
        tables.write_table(supplier.select(F.raise_error(F.lit("no")).cast("string").alias("s_name")), name)
    except Exception as e:  # the error that the rows raise on purpose
        if "USER_RAISED_EXCEPTION" not in str(e):
            raise
    return readers.scan_table(c.spark, name)


@query("verify_write", "SELECT count(*) AS row_count FROM lineitem")
def verify_write(c: Context) -> DataFrame:
    path = c.scratch("lineitem-table")
    tables.write_table(c.table("lineitem"), path)
    return tables.verify_write(c.spark, path)
