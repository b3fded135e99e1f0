"""Data-quality reports.

Each report is a small DataFrame from one pass over its input, never a print. Rows are counted per key
before anything is compared, so a key that holds a large part of the rows is one row afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starledger.operators.reshape import quoted


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def null_counts(df: DataFrame, columns: Sequence[str], total: str | None = "total_rows") -> DataFrame:
    """One row: NULLs in each of the columns (``null_<column>``), and the number of rows."""
    counts = [F.count_if(F.col(quoted(c)).isNull()).alias(f"null_{c}") for c in columns]
    return df.agg(*([F.count("*").alias(total)] if total else []), *counts)


def value_counts(df: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    """Rows per value; NULL is a value."""
    value = F.col(column) if isinstance(column, str) else column
    return df.groupBy(value.alias(name)).agg(F.count("*").alias("row_count"))


def distinct_count(df: DataFrame, columns: Sequence[str], name: str = "distinct_values") -> DataFrame:
    """One row: number of distinct value combinations, those with NULL included."""
    return df.select(*columns).distinct().agg(F.count("*").alias(name))


def _per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_keys") -> DataFrame:
    """One row: number of keys held by more than one row. NULL is a key like others."""
    return _per_key(df, keys).agg(F.count_if(F.col("n") > 1).alias(name))


def duplicate_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def validate_key(df: DataFrame, table: str, key: str | Sequence[str]) -> DataFrame:
    """One row: rows, duplicate keys and rows with a NULL key of a table."""
    keys = [key] if isinstance(key, str) else list(key)
    any_null = F.lit(False)
    for i in range(len(keys)):
        any_null = any_null | F.col(f"k{i}").isNull()
    return _per_key(df, keys).agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).alias("null_keys"),
    )


def _tally(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of either side per key: ``(key, n_left, n_right)``. One shuffle of pre-aggregated keys, no join."""
    both = left.select(F.col(left_key).alias("key"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(F.col(right_key).alias("key"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return both.groupBy("key").agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))


def _total(of: Column, when: Column | None = None) -> Column:
    return F.coalesce(F.sum(of if when is None else F.when(when, of)), F.lit(0))


def validate_relationship(
    fact: DataFrame, dim: DataFrame, fact_name: str, dim_name: str, fact_key: str, dim_key: str
) -> DataFrame:
    """One row: fact rows, fact rows with a NULL key, and fact rows without a dimension row.

    A NULL key matches nothing, so it counts among the rows without one.
    """
    lost = (F.col("n_right") == 0) | F.col("key").isNull()
    return _tally(fact, dim, fact_key, dim_key).agg(
        F.lit(fact_name).alias("fact_name"),
        F.lit(dim_name).alias("dim_name"),
        F.lit(fact_key).alias("fact_key"),
        _total(F.col("n_left")).alias("fact_rows"),
        _total(F.col("n_left"), F.col("key").isNull()).alias("null_foreign_keys"),
        _total(F.col("n_left"), lost).alias("orphan_records"),
    )


def validate_relationships(
    tables: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """:func:`validate_relationship` for many pairs ``(fact, dimension, fact key, dimension key)`` at once.

    Every table is scanned once, whatever the number of its relationships: a row is spread into one small row
    per key, and those are counted per relationship and key before the one shuffle. A relationship is a number on
    the way; names come with the results. Keys are compared as 64-bit numbers where all are whole numbers, else as
    text; the two kinds are counted apart.
    """
    kinds = {name: dict(tables[name].dtypes) for name in {n for p in pairs for n in p[:2]}}
    whole = [all(kinds[name][key] in ("tinyint", "smallint", "int", "bigint") for name, key in ((p[0], p[2]), (p[1], p[3]))) for p in pairs]

    def spread(name: str, at: int, kind: str, mine: Sequence[int]) -> DataFrame:
        keys = [F.struct(F.lit(i).alias("pair"), F.col(pairs[i][2 + at]).cast(kind).alias("key")) for i in mine]
        rows = tables[name].select(F.explode(F.array(*keys)).alias("k")).select("k.*") if len(keys) > 1 else tables[name].select(keys[0].alias("k")).select("k.*")
        return rows.withColumns({"l": F.lit(1 - at), "r": F.lit(at)})

    tallies = []
    for kind, wanted in (("bigint", True), ("string", False)):
        sides = []
        for at in (0, 1):
            for name in dict.fromkeys(p[at] for p in pairs):
                mine = [i for i, p in enumerate(pairs) if p[at] == name and whole[i] == wanted]
                if mine:
                    sides.append(spread(name, at, kind, mine))
        if sides:
            tallied = reduce(DataFrame.unionAll, sides).groupBy("pair", "key").agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
            null = F.col("key").isNull()
            tallies.append(
                tallied.groupBy("pair").agg(
                    _total(F.col("n_left")).alias("fact_rows"),
                    _total(F.col("n_left"), null).alias("null_foreign_keys"),
                    _total(F.col("n_left"), null | (F.col("n_right") == 0)).alias("orphan_records"),
                )
            )

    def named(at: int) -> Column:
        return F.element_at(F.array(*[F.lit(p[at]) for p in pairs]), F.col("pair") + 1)

    return reduce(DataFrame.unionAll, tallies).select(
        named(0).alias("fact_name"), named(1).alias("dim_name"), named(2).alias("fact_key"), "fact_rows", "null_foreign_keys", "orphan_records"
    )


def orphan_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row: distinct keys of either side that the other lacks. NULL is one such key where it occurs."""
    null = F.col("key").isNull()
    return _tally(left, right, left_key, right_key).agg(
        F.count_if((F.col("n_left") > 0) & ((F.col("n_right") == 0) | null)).alias("left_only_keys"),
        F.count_if((F.col("n_right") > 0) & ((F.col("n_left") == 0) | null)).alias("right_only_keys"),
    )


def reconcile_amounts(
    left: DataFrame, right: DataFrame, on: tuple[str, str], left_amount: str, right_amount: str
) -> DataFrame:
    """One row: pairs that join on the key, pairs with equal amounts, pairs with different ones.

    A pair with a NULL amount is neither equal nor different. Pairs are counted, not built: rows are counted
    per key and amount, and the counts of the sides multiply. A key with very many rows on both sides
    therefore costs as many steps as it has amounts.
    """

    def side(df: DataFrame, key: str, amount: str, l: int, r: int) -> DataFrame:
        return df.filter(F.col(key).isNotNull()).select(
            F.col(key).alias("key"), F.col(amount).alias("amount"), F.lit(l).alias("l"), F.lit(r).alias("r")
        )

    per_amount = (
        side(left, on[0], left_amount, 1, 0)
        .unionAll(side(right, on[1], right_amount, 0, 1))
        .groupBy("key", "amount")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    )
    known = F.col("amount").isNotNull()
    per_key = per_amount.groupBy("key").agg(
        _total(F.col("l")).alias("l"),
        _total(F.col("r")).alias("r"),
        _total(F.col("l"), known).alias("l_known"),
        _total(F.col("r"), known).alias("r_known"),
        _total(F.col("l") * F.col("r"), known).alias("equal"),
    )
    return per_key.agg(
        _total(F.col("l") * F.col("r")).alias("matched_records"),
        _total(F.col("equal")).alias("amount_matches"),
        _total(F.col("l_known") * F.col("r_known") - F.col("equal")).alias("amount_differences"),
    )


def totals(df: DataFrame, sums: Mapping[str, str], rows: str = "row_count") -> DataFrame:
    """One row: the number of rows and the sum of each column, ``sums`` giving ``{name: column}``."""
    return df.agg(F.count("*").alias(rows), *[F.sum(column).alias(name) for name, column in sums.items()])


def reconcile_layers(
    first: DataFrame,
    second: DataFrame,
    sums: Mapping[str, tuple[str, str]],
    labels: tuple[str, str] = ("silver", "gold"),
    diff: bool = False,
) -> DataFrame:
    """One row: the totals of two layers side by side, or with ``diff`` the first minus the second.

    ``sums`` gives ``{name: (column of the first, column of the second)}``. Both totals are single rows;
    they are stacked and folded into one, which needs no join.
    """
    parts = []
    for i, df in enumerate((first, second)):
        one = totals(df, {name: columns[i] for name, columns in sums.items()})
        parts.append(one.withColumn("layer", F.lit(i)))
    stacked = parts[0].unionByName(parts[1])

    def of(layer: int, name: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.col(name)))

    names = ["row_count", *sums]
    if diff:
        return stacked.agg(*[(of(0, n) - of(1, n)).alias(f"{n}_difference") for n in names])
    return stacked.agg(*[of(i, n).alias(f"{label}_{n}") for n in names for i, label in enumerate(labels)])


def orphans(left: DataFrame, right: DataFrame, on: Mapping[str, str], skip_null: bool = False) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``, on ``{left column: right column}``.

    A NULL key has no partner and is kept, unless ``skip_null`` removes it first.
    """
    if skip_null:
        left = left.dropna(subset=list(on))
    keys = right.select(*[F.col(r).alias(f"__{r}") for r in on.values()])
    condition = [F.col(quoted(l)) == F.col(f"__{r}") for l, r in on.items()]
    return left.join(keys, condition, "left_anti")


def missing_attribute_count(df: DataFrame, column: str, name: str = "orphan_rows") -> DataFrame:
    """One row: rows whose looked-up attribute found nothing."""
    return df.agg(F.count_if(F.col(column).isNull()).alias(name))
