"""Explode, flatten and select by schema.

Everything here reads ``df.schema`` on the driver and returns one lazy plan. Nothing touches rows, apart
from :func:`drop_all_null_columns`, whose answer depends on them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starledger.functions.scalars import lenient_cast, null_of, parse_timestamp

# A column whose lower-cased name contains one of these holds a timestamp.
TIMESTAMP_KEYWORDS = (
    "created_at",
    "updated_at",
    "calculated_at",
    "occurred_at",
    "sold_at",
    "received_at",
)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# -- explode ---------------------------------------------------------------------------------------


def explode_records(df: DataFrame, column: str, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of an envelope's array. An empty or NULL array gives no row."""
    return df.select(*keep, F.explode(column).alias(record))


def explode_children(
    df: DataFrame, keys: Mapping[str, Column], column: str | Column, child: str = "child", outer: bool = True
) -> DataFrame:
    """One row per child under the parent's ``keys``; ``outer`` keeps childless parents with a NULL child."""
    array = F.col(column) if isinstance(column, str) else column
    exploded = F.explode_outer(array) if outer else F.explode(array)
    return df.select(*[key.alias(name) for name, key in keys.items()], exploded.alias(child))


def array_sizes(df: DataFrame, column: str, name: str = "array_length") -> DataFrame:
    """Length of the envelope array, one row per envelope; NULL for a NULL array."""
    return df.select(F.size(column).alias(name))


# -- project ---------------------------------------------------------------------------------------


def field_type(schema: T.StructType, path: str) -> T.DataType | None:
    """The type a dotted path leads to, or None where the schema does not have it."""
    found: T.DataType = schema
    for part in path.split("."):
        if not isinstance(found, T.StructType):
            return None
        match = next((f for f in found.fields if f.name.lower() == part.lower()), None)
        if match is None:
            return None
        found = match.dataType
    return found


def safe_col(schema: T.StructType, path: str, alias: str, to: str | None = None) -> Column:
    """The column at ``path``, cast to ``to``; a typed NULL where the schema lacks the path."""
    found = field_type(schema, path)
    if found is None:
        return null_of(to or "string").alias(alias)
    column = F.col(".".join(quoted(part) for part in path.split(".")))
    if to is not None and found.simpleString() != to:
        column = lenient_cast(column, to) if isinstance(found, T.StringType) else column.try_cast(to)
    return column.alias(alias)


def project(df: DataFrame, record: str, fields: Iterable[tuple[str, str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Select ``(target, path, type)`` fields of a struct column. Paths the schema lacks give NULL."""
    return df.select(*keep, *[safe_col(df.schema, f"{record}.{path}", name, to) for name, path, to in fields])


def key_first(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[c for c in df.columns if c != key])


def reorder_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def parse_timestamps(
    df: DataFrame, names: Iterable[str] | None = None, keywords: Iterable[str] = TIMESTAMP_KEYWORDS
) -> DataFrame:
    """Turn the named columns, or those whose name contains a keyword, into timestamps, in place."""
    if names is None:
        words = tuple(keywords)
        names = [c for c in df.columns if any(word in c.lower() for word in words)]
    chosen = [n for n in names if not isinstance(df.schema[n].dataType, T.TimestampType)]
    return df.withColumns({n: parse_timestamp(F.col(quoted(n))) for n in chosen})


# -- flatten by schema -----------------------------------------------------------------------------


def flatten_structs(df: DataFrame) -> DataFrame:
    """Expand struct columns, nested ones too, to ``parent_child`` columns.

    The first struct is expanded first, its children going to the end, until no struct is left. The whole
    expansion is resolved on the schema and becomes one ``select``.
    """
    pending = [(f.name, quoted(f.name), f.dataType) for f in df.schema.fields]
    while any(isinstance(t, T.StructType) for _, _, t in pending):
        at = next(i for i, (_, _, t) in enumerate(pending) if isinstance(t, T.StructType))
        name, path, struct = pending.pop(at)
        pending += [(f"{name}_{f.name}", f"{path}.{quoted(f.name)}", f.dataType) for f in struct.fields]
    names = [name.lower() for name, _, _ in pending]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"flattening gives the same column name twice: {', '.join(clashes)}")
    return df.select(*[F.col(path).alias(name) for name, path, _ in pending])


def array_columns(df: DataFrame) -> list[tuple[str, str]]:
    """Name and type of each top-level array column."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def explode_arrays(df: DataFrame) -> DataFrame:
    """Explode array columns in order, flattening after each, until none is left.

    Rows with an empty or NULL array stay, with NULL. Two arrays in one record give all their pairs.
    """
    while arrays := array_columns(df):
        name = arrays[0][0]
        columns = [F.explode_outer(quoted(c)).alias(c) if c == name else F.col(quoted(c)) for c in df.columns]
        df = flatten_structs(df.select(*columns))
    return df


def drop_all_null_columns(df: DataFrame, required: Iterable[str] = ()) -> DataFrame:
    """Drop columns that hold no value in any row, except the ``required`` ones.

    One aggregate over one scan decides for all columns; only one row of counts reaches the driver.
    """
    always = set(required)
    optional = [c for c in df.columns if c not in always]
    if not optional:
        return df
    filled = df.agg(*[F.max(F.col(quoted(c)).isNotNull()).alias(str(i)) for i, c in enumerate(optional)]).first()
    empty = {c for i, c in enumerate(optional) if not filled[i]}
    return df.select(*[quoted(c) for c in df.columns if c not in empty])


def sample_record(df: DataFrame) -> DataFrame:
    """One record as indented JSON text."""
    return df.limit(1).select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("record_json"))
