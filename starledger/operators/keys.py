"""Surrogate keys and one-row-per-key selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from starledger.operators.reshape import key_first, quoted
from starledger.session import stage

_TIE, _ROW, _PLACE, _RANGE, _BEFORE = "__tie", "__row", "__place", "__range", "__before"
# monotonically_increasing_id keeps the partition number above bit 33 and the row number below it.
_ROW_BITS = 33
# So many columns that are not kept cost a shuffle more than a hash of them.
_MANY = 4
_FIXED = ("boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "float", "double")


def surrogate_key(
    df: DataFrame, order_by: Sequence[str], name: str, carry: bool = False, keep: Sequence[str] | None = None,
    folders: Mapping[str, Column] | None = None, sort_by: Sequence[str] = (),
) -> DataFrame:
    """Add dense keys 1..n in the order of ``order_by`` (NULL first), as the first column.

    No task sees all rows, and no row is sorted with its payload. Rows are staged once with an address. Only the
    order columns, a hash of the row and the address are range-partitioned, sorted and numbered inside their range;
    each range adds the row count of the ranges before it. The numbers are then joined back by address through a
    hash join, which shuffles rows but does not sort them. A frame of order columns alone has no payload: it is
    numbered as it is, and with ``carry`` so are rows with a few more columns: they are shuffled and written once,
    which costs less than an address and a join for each. ``keep`` names the columns that the result has, all if not
    given; others are not carried beyond the order. Rows that tie on ``order_by`` are told apart by the hash, and exact
    copies by their address, so a hot key or a large group of copies is spread over many ranges. Carried rows need no
    address: the number of their task tells copies apart as far as that takes, and a retried task repeats it.

    Numbered ranges are staged in the shared folder: range bounds come from sampling, so counting the ranges and
    adding the offsets must read the same written rows. ``folders`` names columns, and what they hold, that carried rows
    get when they are staged and are stored by, sorted by ``sort_by`` inside, so that conditions on them prune files.
    """
    columns = [quoted(c) for c in df.columns]
    kept = columns if keep is None else [quoted(c) for c in keep]
    order = [quoted(c) for c in order_by]
    tie, by = F.xxhash64(*columns), [*order, _TIE, _ROW]
    if carry or set(df.columns) <= set(order_by):
        payload, rows = kept, df.select(*columns, F.spark_partition_id().alias(_ROW))
        whole, few = list(dict.fromkeys([*order, *columns, _ROW])), list(dict.fromkeys([*order, *kept, _ROW]))
        if len(whole) - len(few) < _MANY:
            # The hash cuts the ranges but is not shuffled: it is made again of the columns it is made of.
            ranged = rows.select(*whole).repartitionByRange(*order, tie, _ROW).withColumn(_TIE, tie)
        else:
            ranged = rows.select(*few, tie.alias(_TIE)).repartitionByRange(*by)
    else:
        payload, rows = [_ROW], stage(df.select(*columns, tie.alias(_TIE)).withColumn(_ROW, F.monotonically_increasing_id()), name)
        ranged = rows.select(*by).repartitionByRange(*by)
    ranged = ranged.sortWithinPartitions(*by).select(*payload, F.monotonically_increasing_id().alias(_PLACE))
    folders = dict(folders or {}) if payload is kept else {}
    if folders:
        ranged = ranged.withColumns(folders).sortWithinPartitions(*folders, *sort_by)
    placed = stage(ranged, name, tuple(folders)) if folders else stage(ranged, name)
    row_range = F.shiftright(_PLACE, _ROW_BITS)
    # One row per range: never more than the session's shuffle partitions, whatever the data holds.
    running = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy(row_range.alias(_RANGE))
        .count()
        .select(_RANGE, F.coalesce(F.sum("count").over(running), F.lit(0)).alias(_BEFORE))
    )
    in_range = F.col(_PLACE) - F.shiftleft(F.col(_RANGE), _ROW_BITS)
    numbers = placed.withColumn(_RANGE, row_range).join(F.broadcast(before), _RANGE).select((F.col(_BEFORE) + in_range + 1).alias(name), *payload, *folders)
    if payload is kept:
        return key_first(numbers, name)
    return key_first(rows.join(numbers.hint("shuffle_hash"), _ROW).select(name, *kept), name)


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    """The row of the picked ``order_by`` values per key; of ties, the picked one by its columns in order.

    The picked values come from rows of keys and order columns alone; whole rows are then compared only where they
    tie on them. Frames that have no other columns are compared at once.
    """
    key, order = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], [F.col(c).alias(f"r{i}") for i, c in enumerate(order_by)]
    names, kinds = [f"k{i}" for i in range(len(keys))], dict(df.dtypes)
    if not set(df.columns) <= {*keys, *order_by}:
        narrow = df.select(*key, *order)
        if pick is F.max and len(order) == 1 and kinds.get(order_by[0]) in _FIXED:
            # A maximum of one fixed-size value is kept in a hash table; NULL is the smallest either way.
            best = narrow.groupBy(*names).agg(F.max("r0").alias("r0"))
        else:
            best = narrow.groupBy(*names).agg(pick(F.struct(*[f"r{i}" for i in range(len(order))])).alias("p")).select(*names, "p.*")
        best = best.toDF(*[f"__{n}" for n in best.columns])
        pairs = [(k, f"__k{i}") for i, k in enumerate(keys)] + [(c, f"__r{i}") for i, c in enumerate(order_by)]
        df = df.join(best, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in pairs]), "left_semi")
    ranked = df.select(*key, F.struct(*order, F.struct("*").alias("row")).alias("ranked"))
    return ranked.groupBy(*names).agg(pick("ranked").alias("picked")).select("picked.row.*")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` values per key; NULL is the smallest.

    A maximum rather than a row number: each task keeps one narrow row per key before the shuffle, so a key with
    very many rows costs no more than others. Ties go to the greatest row by its columns in order.
    """
    return _pick(df, keys, order_by, F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order_by`` values per key; NULL is the smallest. See :func:`latest_per_key`."""
    return _pick(df, keys, order_by, F.min)
