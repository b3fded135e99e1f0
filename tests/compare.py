"""Run registered queries next to their SQL on the same files and compare the rows.

``python tests/compare.py [--sf DIR] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"dec {value.normalize()}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value if value is None or isinstance(value, (str, int, bool, dt.date)) else str(value)


_KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int32", "integer": "int32", "bigint": "int64", "hugeint": "huge",
    "float": "float", "double": "double", "string": "text", "varchar": "text", "boolean": "bool", "date": "date",
    "timestamp": "time", "timestamp_ntz": "time",
}


def kind(name: str) -> str:
    name = name.lower()
    return "decimal" if name.startswith("decimal") else _KINDS.get(name, name)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, con, sf_dir: str, run, sql: str | None) -> tuple[bool, str]:
    """Whether rows, names and types agree, and what differs."""
    df = run(spark, sf_dir)
    got_rows = df.collect()
    if sql is None:
        return True, f"{len(got_rows)} rows, no SQL"
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want_types = {d[0]: kind(str(d[1])) for d in cursor.description}
    want_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(want_names):
        return False, f"columns {sorted(df.columns)} != {sorted(want_names)}"
    got_types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    types = {n: (got_types[n], want_types[n]) for n in want_names if got_types[n] != want_types[n]}
    if types:
        return False, f"types {types}"
    got, want = rows_of(df.columns, got_rows), rows_of(want_names, want_rows)
    if got == want:
        return True, f"{len(got_rows)} rows"
    lost, extra = want - got, got - want
    sample = f"spark {list(extra)[:2]} sql {list(lost)[:2]}"
    return False, f"{len(got_rows)} rows != {len(want_rows)}; columns {sorted(want_names)}: {sample}"


def main(args: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from starledger.session import local_session

    sf_dir = "/root/testdata/sf0.001"
    if "--sf" in args:
        at = args.index("--sf")
        sf_dir = args[at + 1]
        args = args[:at] + args[at + 2 :]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("OFF")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            ok, text = check(spark, con, sf_dir, run, sql.get(name))
        except Exception as e:  # noqa: BLE001  (report every query)
            ok, text = False, f"{type(e).__name__}: {str(e)[:500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {text[:900]}", flush=True)
    print("failed:", bad)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
