import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from starledger.session import scratch_path
from starledger.sources import bronze, pages, readers, tables
from starledger.sources.schemas import envelope, record_type


def test_pages_after_the_first_without_cursor_are_left_out(spark):
    body = [
        (2, '{"records":[{"id":"c"}]}'),
        (1, '{"cursor":"x","records":[{"id":"a"},{"id":"b"}]}'),
        (3, '{"cursor":"y","records":[{"id":"late"}]}'),
        (0, '{"cursor":"w"}'),
    ]
    df = spark.createDataFrame(body, "page_no int, body string")
    got = pages.merge_pages(df, "records", "struct<id:string>").orderBy("page_no", "position")
    assert [tuple(r) for r in got.select("page_no", "position", "record.id").collect()] == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]
    assert tuple(pages.page_report(df, "records", "struct<id:string>").first()) == (3, 3)


def test_bronze_snapshots_repeat_the_entity(spark):
    path = scratch_path(spark, "test-bronze")
    df = spark.createDataFrame([(("1",),), (("2",),)], "record struct<id:string>")
    first = bronze.write_bronze(df, path, "service", "20240101", "L")
    for _ in range(2):  # delivered again, it replaces itself
        bronze.write_bronze(df, path, "service", "20240102")
    assert tuple(first.first()) == ("20240101", "service", "L", 2)
    back = bronze.read_bronze(spark, path, df.schema)
    assert back.count() == 4 and back.filter(F.col("location_id").isNull()).count() == 2


def test_multi_line_json_and_absent_fields(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "ingested_at": "2024-01-01T00:00:00Z",\n "customers": [\n {"id": "1"}\n ]\n}')
    (tmp_path / "b.json").write_text('{"customers": null}')
    df = readers.scan_json(spark, str(tmp_path), envelope("customers"))
    assert df.count() == 2
    (tmp_path / "c.json").write_text("\n")
    (tmp_path / "d.json").write_text("")  # a file of no bytes is none to Spark's readers
    files = readers.source_files(spark, str(tmp_path), df.select("*", "_metadata"))
    assert sorted(r.row_count for r in files.collect()) == [0, 1, 1]


def test_chains_end_apart_and_one_without_an_end_is_whole(spark):
    rows = [("a", 1, '{"records":[{"id":"1"}]}'), ("a", 2, '{"records":[{"id":"late"}]}'), ("b", 5, '{"cursor":"x","records":[{"id":"2"}]}'), (None, 7, '{"records":[{"id":"3"}]}')]
    df = spark.createDataFrame(rows, "source string, page_no int, body string")
    got = pages.merge_pages(df, "records", "struct<id:string>", ["source"])
    assert {(r.source, r.record.id) for r in got.collect()} == {("a", "1"), ("b", "2"), (None, "3")}


def test_flat_records_keep_fields_named_like_the_snapshots(spark):
    path = scratch_path(spark, "test-flat")
    df = spark.createDataFrame([("1", "web", "L9")], "id string, source string, location_id string")
    bronze.write_bronze(df, path, "orders service", "20240101", "L1")
    row = bronze.read_bronze(spark, path, T.StructType().add("record", df.schema)).first()
    assert (row.source, row.location_id, row.record.source, row.record.location_id) == ("orders service", "L1", "web", "L9")


def test_bad_records_are_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":"1"}\n{"id":\n')
    df = readers.scan_json_lines(spark, str(tmp_path), "id string", bad="bad")
    assert tuple(readers.bad_records(df, "bad").first()) == (2, 1)


def test_partitioned_table_and_a_failing_write_that_keeps_the_old_one(spark):
    path = scratch_path(spark, "test-parts")
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("day"))
    tables.write_table(df, path, partition_by=["day"])
    tables.write_table(df, path, partition_by=["day"])
    assert readers.scan_table(spark, path).where("day = 1").count() == 33
    failing = df.withColumn("id", F.expr("if(id = 50, raise_error('no'), id)"))
    with pytest.raises(Exception):
        tables.write_table(failing, path)
    assert readers.scan_table(spark, path).count() == 100


def test_strict_write_refuses_another_schema_and_empty_rows_change_nothing(spark):
    path = scratch_path(spark, "test-table")
    df = spark.range(3)
    assert tables.write_table(df, path, evolve_schema=False)
    with pytest.raises(ValueError):
        tables.write_table(df.select(F.col("id").cast("string")), path, evolve_schema=False)
    assert not tables.write_table(df.filter("id > 5"), path, skip_empty=True)
    assert tables.verify_write(spark, path).first()[0] == 3


def test_typed_and_empty_rows(spark):
    text = spark.createDataFrame([('{"id":"1","version":3}',)], "body string")
    typed = readers.typed_rows(text, "body", record_type("customers"))
    assert typed.first()["version"] == 3
    empty = readers.empty_rows(spark, typed.schema)
    assert empty.columns == typed.columns and empty.isEmpty()


# --- cursors ----------------------------------------------------------------------------------------------------


def brute_links(rows):
    """Pages per chain in the order of their cursors, and how the chain ends."""
    out = {}
    for chain in {r[0] for r in rows}:
        pages = {}
        for _, asked, body in (r for r in rows if r[0] == chain):
            pages.setdefault(asked or "", body)
        order, at, ends, missing = [], "", "no first page", None
        while at in pages and at not in order:
            order.append(at)
            at = json.loads(pages[at]).get("cursor") or ""
            ends, missing = ("complete", None) if at == "" else ("loop", None) if at in order else ("gap", None) if at in pages else ("gap", at)
        out[chain] = ([pages[a] for a in order], ends, missing, len(pages) - len(order))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_cursors_put_pages_in_order_and_gaps_and_loops_are_reported(spark, seed):
    rng, rows = random.Random(seed), []
    page = lambda chain, i, to: json.dumps({"cursor": to, "records": [{"id": f"{chain}-{i}-{k}"} for k in range(i % 3)]} if to else {"records": [{"id": f"{chain}-{i}"}]})
    for chain in ["a", "b", None, "", "c", "d", "e", "f"]:
        n = rng.choice([1, 2, 3, 17, 40])
        names = [rng.choice([None, ""])] + [f"{rng.random()}" for _ in range(n - 1)]
        for i in range(n):
            if chain == "c" and i == n // 2 and n > 1 or chain == "f" and i == 0:
                continue  # a page that never came
            to = names[i + 1] if i + 1 < n else "nowhere" if chain == "d" else names[n // 2] if chain == "e" else None
            rows.append((chain, names[i], page(chain, i, to)))
    rows += [("b", "lost", page("b", 99, None)), ("g", "z", page("g", 1, "y")), ("g", "y", page("g", 2, "z"))]
    given = rows + rows[::4]
    rng.shuffle(given)
    df = spark.createDataFrame(given, "source string, asked string, body string").repartition(3)
    linked = pages.link_pages(df, ["source"])
    want = brute_links(rows)
    got = {}
    for r in linked.filter("page_no is not null").orderBy("page_no").collect():
        got.setdefault(r.source, []).append(r.body)
    assert got == {c: w[0] for c, w in want.items() if w[0]}
    report = {r.source: (r.pages, r.ends, r.missing, r.unreached) for r in pages.link_report(linked, "records", "struct<id:string>", ["source"]).collect()}
    assert report == {c: (len(w[0]), w[1], w[2], w[3]) for c, w in want.items()}
    merged = pages.merge_linked_pages(linked, "records", "struct<id:string>", ["source"]).collect()
    assert sorted((str(r.source), r.record.id) for r in merged) == sorted((str(c), x["id"]) for c, w in want.items() for b in w[0] for x in json.loads(b)["records"])
    assert pages.link_pages(df.limit(0), ["source"]).count() == 0


# --- schemas, footers, listing, swaps ---------------------------------------------------------------------------


def test_schemas_widen_over_files_by_the_stated_rules(spark, tmp_path):
    files = {
        "a": ['{"id":1,"n":1,"x":null,"t":{"a":1},"l":[1],"m":[{"k":1}]}', '{"id":2,"odd name":true}'],
        "b": ['{"id":3,"n":1.5,"x":null,"t":{"b":"s"},"l":[2.5],"m":[{"q":false}]}', "{not json"],
        "c": ['{"id":4,"n":"text","o":{},"t":null,"l":[],"m":null,"v":[1,"a"]}', ""],
    }
    for name, lines in files.items():
        (tmp_path / f"{name}.json").write_text("\n".join(lines) + "\n")
    schema = readers.merged_schema(spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {
        "id": "bigint", "n": "string", "x": "string", "o": "string", "t": "struct<a:bigint,b:string>", "l": "array<double>",
        "m": "array<struct<k:bigint,q:boolean>>", "odd name": "boolean", "v": "array<string>",
    }
    rows = {r.id: r for r in readers.scan_json_merged(spark, str(tmp_path)).filter("id is not null").collect()}
    assert (rows[1].n, rows[3].n, rows[4].n, rows[4].o, rows[2].t, rows[1].l, rows[4].v) == ("1", "1.5", "text", "{}", None, [1.0], ["1", "a"])
    per_file = {r.file_path[-6]: (r.records, r.bad_records) for r in readers.file_schemas(spark, str(tmp_path)).collect()}
    assert per_file == {"a": (2, 0), "b": (2, 1), "c": (1, 0)}
    whole = tmp_path / "whole"
    whole.mkdir()
    (whole / "a.json").write_text('[\n{"id": 1},\n{"id": 2.5, "s": "x"}\n]')
    (whole / "b.json").write_text('{\n"id": 7\n}')
    with pytest.raises(ValueError):  # a list of records in one file and a record in another
        readers.merged_schema(spark, str(whole), multi_line=True)
    (whole / "b.json").unlink()
    assert [tuple(r) for r in readers.scan_json_merged(spark, str(whole), multi_line=True).collect()] == [(1.0, None), (2.5, "x")]


def test_counts_and_bounds_come_from_footers(spark):
    path = scratch_path(spark, "test-footers")
    df = spark.range(1000).selectExpr("id", "cast(id % 3 as int) part", "date_add(date'2024-01-01', cast(id as int)) day", "if(id % 2 = 0, id, null) half")
    tables.write_table(df, path, partition_by=["part"], sort_by=["id"])
    out = readers.stored_bounds(spark, path, ["id", "day", "half"], F.col("part") > 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(day), MAX(day), MIN(half), MAX(half)]" in plan and "BatchScan" in plan
    row = out.first()
    assert (row.row_count, row.min_id, row.max_id, row.max_half, str(row.min_day)) == (666, 1, 998, 998, "2024-01-02")
    assert tables.verify_write(spark, path).first()[0] == 1000
    assert "FileScan parquet" in spark.read.parquet(path)._jdf.queryExecution().executedPlan().toString()


def test_listing_opens_no_file_and_finds_those_below(spark, tmp_path):
    (tmp_path / "day=1").mkdir()
    for name in ("a.json", "day=1/b.json", "_hidden", ".c"):
        (tmp_path / name).write_text("x" * len(name))
    files = readers.source_files(spark, str(tmp_path))
    assert {(r.file_path.rsplit("/", 1)[1], r.length) for r in files.collect()} == {("a.json", 6), ("b.json", 12)}
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


@pytest.mark.parametrize("kind", ["path", "catalog", "fixed"])
def test_a_failing_write_leaves_the_old_table(spark, kind):
    name = scratch_path(spark, "test-swap") if kind != "catalog" else "test_swap_table"
    write = (lambda df: bronze.write_fixed(df, name)) if kind == "fixed" else (lambda df: tables.write_table(df, name))
    read = (lambda: spark.read.json(name)) if kind == "fixed" else (lambda: readers.scan_table(spark, name))
    write(spark.range(5))
    bad = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("no")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write(bad)
    assert read().count() == 5
    if kind != "fixed":
        assert tables.write_table(read().filter("id < 2"), name)  # a table can be made of itself
        assert read().count() == 2
    if kind == "catalog":
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("test_swap_table_")]
        spark.sql(f"DROP TABLE {name}")


def test_text_that_cannot_be_read_is_kept(spark):
    df = spark.createDataFrame([('{"id":1,"s":"a"}',), ("{oops",), ('{"id":"x"}',), (None,)], "body string")
    got = [tuple(r) for r in readers.typed_rows(df, "body", "id bigint, s string", bad="unread").collect()]
    assert got == [(1, "a", None), (None, None, "{oops"), (None, None, '{"id":"x"}'), (None, None, None)]
