"""The star's relationships and the evaluation of measures over it.

A measure is built from parts, each one aggregate over one table. Facts are never joined to each other:
every fact is aggregated on its own, and the results are stacked and folded on the group columns. A fact is
reduced by its own keys before it meets a dimension, whatever the aggregate.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Tables = Mapping[str, DataFrame]
Filters = Mapping[str, Column]

# Fixed values: (table, dimension): (column of the table, column of the dimension). Many to one.
RELATIONSHIPS = {
    ("fact_sales", "dim_date"): ("date_key", "date_key"),
    ("fact_order", "dim_date"): ("date_key", "date_key"),
    ("fact_payment", "dim_date"): ("date_key", "date_key"),
    ("fact_inventory", "dim_date"): ("date_key", "date_key"),
    ("fact_sales", "dim_location"): ("location_key", "location_key"),
    ("fact_order", "dim_location"): ("location_key", "location_key"),
    ("fact_payment", "dim_location"): ("location_key", "location_key"),
    ("fact_inventory", "dim_location"): ("location_key", "location_key"),
    ("fact_sales", "dim_customer"): ("customer_key", "customer_key"),
    ("fact_order", "dim_customer"): ("customer_key", "customer_key"),
    ("fact_payment", "dim_customer"): ("customer_key", "customer_key"),
    ("fact_sales", "dim_product"): ("variation_id", "variation_id"),
    ("fact_inventory", "dim_product"): ("product_key", "product_key"),
}


# Facts stored by month have this column; it joins the month of the date dimension, so that a condition on
# dates prunes their folders.
MONTH, MONTH_OF_DATE = "date_month", "year_month_number"


@dataclass(frozen=True)
class Part:
    """One aggregate over one table.

    With ``per`` the table is first aggregated by that column into ``inner``, and ``of`` aggregates those
    rows. ``replaces`` names a column whose grouping the part's own condition replaces.

    How rows may be reduced before they are joined to dimensions is stated by ``merge`` (sum, max or min: results
    of parts of the rows are put together by it) or by ``distinct`` (only the distinct values of that column
    count). With ``per`` both speak of the inner aggregate. ``where`` limits the rows that count.

    ``back`` (day or month) takes the rows of the dates that lie so much earlier than those of the context.
    ``reads`` names all columns of the table that the functions above use; without it any may be used.
    """

    table: str
    of: Callable[[], Column]
    per: str | None = None
    inner: Callable[[], Column] | None = None
    replaces: str | None = None
    merge: str | None = None
    distinct: str | None = None
    where: Callable[[], Column] | None = None
    back: str | None = None
    reads: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Measure:
    """A value computed from named parts. A ``never_blank`` one has a value for members without facts too."""

    parts: tuple[str, ...]
    value: Callable[..., Column]
    never_blank: bool = False


def related(table: str, other: str) -> bool:
    """Whether columns of ``other`` filter and group ``table``."""
    return table == other or (table, other) in RELATIONSHIPS


def in_context(
    tables: Tables, table: str, groups: Mapping[str, tuple[str, str]] | None = None, filters: Filters | None = None
) -> DataFrame:
    """A table under filters, with group columns added: ``groups`` gives ``{name: (table, column)}``.

    Only dimensions that a filter or a group names are joined, and only their needed columns. A filtered
    dimension keeps matching rows; otherwise rows without a match stay, with NULL. Filters that have no path
    to the table do not apply.
    """
    groups, filters = groups or {}, filters or {}
    return _joined(_own(tables, table, groups, filters), tables, table, groups, filters)


def _own(tables: Tables, table: str, groups: Mapping[str, tuple[str, str]], filters: Filters) -> DataFrame:
    """A table under its own filter, with the group columns it owns."""
    df = tables[table]
    if table in filters:
        df = df.filter(filters[table])
    return df.withColumns({name: F.col(column) for name, (owner, column) in groups.items() if owner == table})


def earlier_dates(
    calendar: DataFrame, unit: str, groups: Mapping[str, str] | None = None, condition: Column | None = None
) -> DataFrame:
    """The dates one ``unit`` (day or month) before those that ``condition`` selects, once per group.

    ``groups`` gives ``{name: column}`` of the calendar. Every selected date moves back; a day that the earlier
    month lacks falls on its last day. A group that selects the last two days of a month also gets what is left of
    the earlier month after them, so whole months move to whole months. Only dates of the calendar are found.
    Rows: the calendar's date_key (and month), and the groups. A date can be earlier than several groups.
    """
    groups = dict(groups or {})
    days = calendar if condition is None else calendar.filter(condition)
    days = days.filter(F.col("date").isNotNull()).select("date", *[F.col(c).alias(n) for n, c in groups.items()]).distinct()
    if unit == "day":
        moved = days.withColumn("date", F.date_sub("date", 1))
    else:
        ends = days.filter(F.date_add("date", 2) > F.last_day("date")).groupBy(F.last_day("date").alias("__end"), *groups).agg(F.count("*").alias("__n"))
        same = F.add_months("__end", -1)
        rest = ends.filter((F.col("__n") == 2) & (same < F.last_day(same)))
        rest = rest.select(F.explode(F.sequence(F.date_add(same, 1), F.last_day(same))).alias("date"), *groups)
        moved = days.withColumn("date", F.add_months("date", -1)).unionByName(rest)
    months = [F.col(MONTH_OF_DATE).alias(MONTH)] if MONTH_OF_DATE in calendar.columns else []
    known = calendar.select("date", F.col("date_key").alias("__date"), *months)
    return moved.distinct().join(known, "date").drop("date")


def _reached_dims(table: str, groups: Mapping[str, tuple[str, str]], filters: Filters, back: str | None = None) -> list[str]:
    """The dimensions that a table is joined to for its groups, filters and earlier dates."""
    named = {owner for owner, _ in groups.values()} | set(filters) | ({"dim_date"} if back else set())
    return sorted(d for d in named if (table, d) in RELATIONSHIPS)


def _by_month(tables: Tables, table: str, dim: str, inner: bool) -> bool:
    """Whether a join selects among a fact's stored months."""
    return inner and dim == "dim_date" and MONTH in tables[table].columns and MONTH_OF_DATE in tables[dim].columns


def _keys(tables: Tables, table: str, dims: Sequence[str], filters: Filters, back: str | None) -> list[str]:
    """The columns of a table that its joins to dimensions need."""
    keys = []
    for d in dims:
        keys.append(RELATIONSHIPS[table, d][0])
        if _by_month(tables, table, d, d in filters or bool(back)):
            keys.append(MONTH)
    return list(dict.fromkeys(keys))


def _joined(
    df: DataFrame, tables: Tables, table: str, groups: Mapping[str, tuple[str, str]], filters: Filters, back: str | None = None, apart: str | None = None
) -> DataFrame:
    """Rows with the keys of a table, joined to the dimensions that filters and groups name.

    With ``back`` the date dimension is replaced by the earlier dates of the context. Rows with a NULL key match
    nothing; where they are many, ``apart`` names a column by which they are dealt over all tasks of the join.
    """
    for dim in _reached_dims(table, groups, filters, back):
        key, dim_key = RELATIONSHIPS[table, dim]
        wanted = {name: column for name, (owner, column) in groups.items() if owner == dim}
        moved = back if dim == "dim_date" else None
        month = _by_month(tables, table, dim, dim in filters or bool(moved))
        if moved:
            side = earlier_dates(tables[dim], moved, wanted, filters.get(dim))
        else:
            side = tables[dim].filter(filters[dim]) if dim in filters else tables[dim]
            months = [F.col(MONTH_OF_DATE).alias(MONTH)] if month else []
            side = side.select(F.col(dim_key).alias("__date"), *months, *[F.col(c).alias(n) for n, c in wanted.items()])
        side = side.withColumnsRenamed({"__date": f"__{dim}", MONTH: "__month"})
        how = "inner" if dim in filters or moved else "left"
        same = F.col(key) == F.col(f"__{dim}")
        if month:
            same = same & (F.col(MONTH) == F.col("__month"))
        if apart and how == "left":
            # A NULL key gets a number from 1 up, all others 0; the dimension's is 0, written so that it stays a key.
            df = df.withColumn("__deal", F.when(F.col(key).isNull(), F.pmod(F.xxhash64(apart), F.lit(1000)) + 1).otherwise(0))
            side = side.withColumn("__zero", F.pmod(F.xxhash64(f"__{dim}"), F.lit(1)))
            same = same & (F.col("__deal") == F.col("__zero"))
        df = df.join(side, same, how).drop(f"__{dim}", "__month", "__deal", "__zero")
    return df


def limited_by_stock(tables: Tables, stock: Column) -> tuple[Tables, Filters]:
    """Let a condition on stock rows filter products too, and so sales: the relationship that works both ways.

    Returns the tables and the filters to evaluate with.
    """
    limited = _Limited(tables, stock) if hasattr(tables, "only") else _limited(tables, stock)
    return limited, {"fact_inventory": stock, "dim_product": F.lit(True)}


def _limited(tables: Tables, stock: Column) -> Tables:
    kept = tables["fact_inventory"].filter(stock).select("product_key").distinct()
    return ChainMap({"dim_product": tables["dim_product"].join(kept, "product_key", "left_semi")}, tables)


class _Limited(Mapping):
    """Tables that give facts of few columns; products are limited by the stock of those that are asked for."""

    def __init__(self, tables: Tables, stock: Column):
        self._tables, self._stock = tables, stock

    def only(self, needed: Mapping[str, Collection[str] | None], months: bool = False) -> Tables:
        columns = needed.get("fact_inventory")
        stock = None if columns is None else {*columns, "product_key"}
        return _limited(self._tables.only({**needed, "fact_inventory": stock}, months), self._stock)

    def __getitem__(self, name: str) -> DataFrame:
        return _limited(self._tables, self._stock)[name] if name == "dim_product" else self._tables[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def _aggregate(
    tables: Tables, table: str, groups: Mapping[str, tuple[str, str]], filters: Filters, parts: Mapping[str, Part]
) -> list[DataFrame]:
    """Results of the parts of a table per group.

    Rows are reduced by the table's own keys in the tasks that read them, and only what is left is joined to
    dimensions and put together: one row per key for parts that merge, one per key and value for distinct
    counts, one per key and inner key for two-step parts. So a hot key is one row per task in the join of
    merged parts, and the many values of a NULL key are dealt over all tasks.
    """
    frames = []
    for back in dict.fromkeys(p.back for p in parts.values()):
        some = {name: p for name, p in parts.items() if p.back == back}
        dims = _reached_dims(table, groups, filters, back)
        if dims:
            frames += _reduced(tables, table, groups, filters, some, back, _keys(tables, table, dims, filters, back))
        else:
            frames += _whole(_own(tables, table, groups, filters), list(groups), some)
    return frames


def _reduced(
    tables: Tables, table: str, groups: Mapping[str, tuple[str, str]], filters: Filters, parts: Mapping[str, Part], back: str | None, keys: Sequence[str]
) -> list[DataFrame]:
    """Results of parts whose groups or filters need dimensions."""
    own = [name for name, (owner, _) in groups.items() if owner == table]
    rows = _own(tables, table, groups, filters)
    frames, rest = [], {}
    merged = {name: p for name, p in parts.items() if p.merge and p.per is None}
    if merged:
        first = rows.groupBy(*own, *keys).agg(*[p.of().alias(name) for name, p in merged.items()])
        kinds = dict(first.dtypes)
        again = [getattr(F, p.merge)(name).cast(kinds[name]).alias(name) for name, p in merged.items()]
        frames.append(_joined(first, tables, table, groups, filters, back).groupBy(*groups).agg(*again))
    for name, p in parts.items():
        if name in merged:
            continue
        some = rows if p.where is None else rows.filter(p.where())
        if p.per is not None and list(keys) == [p.per]:
            first = some.groupBy(*own, p.per).agg(p.inner().alias("inner_value"))
            frames.append(_joined(first, tables, table, groups, filters, back).groupBy(*groups).agg(p.of().alias(name)))
        elif p.per is not None and p.merge:
            first = some.groupBy(*dict.fromkeys([*own, *keys, p.per])).agg(p.inner().alias("inner_value"))
            kind = dict(first.dtypes)["inner_value"]
            steps = _joined(first, tables, table, groups, filters, back, p.per).groupBy(*groups, p.per)
            steps = steps.agg(getattr(F, p.merge)("inner_value").cast(kind).alias("inner_value"))
            frames.append(steps.groupBy(*groups).agg(p.of().alias(name)))
        elif p.distinct:
            first = some.select(*dict.fromkeys([*own, *keys, *([p.per] if p.per else []), p.distinct])).distinct()
            met = _joined(first, tables, table, groups, filters, back, p.distinct)
            if p.per is not None:
                frames += _whole(met, list(groups), {name: replace(p, where=None)})
                continue
            values = met.select(*groups, F.col(p.distinct).alias("value")).distinct()
            frames.append(values.groupBy(*groups).agg(F.when(F.count("*") > 0, F.count("*")).alias(name)))
        else:
            rest[name] = p
    if rest:
        frames += _whole(_joined(rows, tables, table, groups, filters, back), list(groups), rest)
    return frames


def _whole(df: DataFrame, groups: Sequence[str], parts: Mapping[str, Part]) -> list[DataFrame]:
    """One frame for the plain parts of a table, one for each two-step part."""
    plain = {name: p for name, p in parts.items() if p.per is None}
    frames = []
    if plain:
        frames.append(df.groupBy(*groups).agg(*[p.of().alias(name) for name, p in plain.items()]))
    for name, p in parts.items():
        if p.per is not None:
            some = df if p.where is None else df.filter(p.where())
            steps = some.groupBy(*groups, p.per).agg(p.inner().alias("inner_value"))
            frames.append(steps.groupBy(*groups).agg(p.of().alias(name)))
    return frames


def _members(tables: Tables, groups: Mapping[str, tuple[str, str]], filters: Filters) -> list[DataFrame]:
    """The members that never-blank measures show: of one table all of its rows', of several the combinations in any fact.

    All pairs of members would be a cross join of dimensions; a combination counts here when some fact that
    reaches all of the groups has it. Facts give distinct keys before they are joined.
    """
    owners = {owner for owner, _ in groups.values()}
    if len(owners) == 1:
        return [in_context(tables, next(iter(owners)), groups, filters).select(*groups).distinct()]
    frames = []
    for fact in dict.fromkeys(t for t, _ in RELATIONSHIPS):
        if fact not in set(tables) or not all(related(fact, owner) for owner in owners):
            continue
        own = [name for name, (owner, _) in groups.items() if owner == fact]
        keys = _keys(tables, fact, _reached_dims(fact, groups, filters), filters, None)
        first = _own(tables, fact, groups, filters).select(*own, *keys).distinct()
        frames.append(_joined(first, tables, fact, groups, filters).select(*groups).distinct())
    return frames


def _fold(frames: Sequence[DataFrame], groups: Sequence[str]) -> DataFrame:
    """Put results that share group columns side by side: a full outer join in which NULL equals NULL."""
    if len(frames) == 1:
        return frames[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    values = [c for c in stacked.columns if c not in groups]
    return stacked.groupBy(*groups).agg(*[F.max(c).alias(c) for c in values])


def columns_read(
    groups: Mapping[str, tuple[str, str]], parts: Mapping[str, Part], filters: Collection[str] = (), reads: Mapping[str, Collection[str]] | None = None
) -> dict[str, set[str] | None]:
    """The columns of each fact that parts read under groups and filters; None where a part or a fact's own filter does not say.

    ``filters`` are the tables that have one: one of a dimension reaches a fact by its key, of one of a fact ``reads`` gives the
    columns. A fact that no part reads may still show which groups occur, by its keys.
    """
    owners, read, reads = {owner for owner, _ in groups.values()}, {}, reads or {}
    for fact in dict.fromkeys(t for t, _ in RELATIONSHIPS):
        mine = [p for p in parts.values() if p.table == fact]
        if any(p.reads is None for p in mine) or fact in filters and fact not in reads:
            read[fact] = None
            continue
        reached = owners | set(filters) | ({"dim_date"} if any(p.back for p in mine) else set())
        read[fact] = {c for p in mine for c in p.reads} | {column for owner, column in groups.values() if owner == fact}
        read[fact] |= set(reads[fact]) if fact in filters else set()
        read[fact] |= {RELATIONSHIPS[fact, d][0] for d in reached if (fact, d) in RELATIONSHIPS}
    return read


def evaluate(
    tables: Tables,
    library: tuple[Mapping[str, Part], Mapping[str, Measure]],
    measures: Sequence[str],
    group_by: Sequence[str] = (),
    filters: Filters | None = None,
    reads: Mapping[str, Collection[str]] | None = None,
) -> DataFrame:
    """Measures, alone or per group; ``group_by`` names columns as ``table.column``.

    ``filters`` gives a condition per table and reaches every related fact. A part whose table has no path to
    some of the group columns is evaluated over the others and repeated; without a path to any it shows its
    total under every group. Never-blank measures bring the members of the groups' table that have no facts, and
    of groups of several tables the combinations that any fact has. Groups in which all measures are NULL are
    left out.

    Tables with a method ``only`` are asked for facts of no more than the columns that are read, stored by month where dates
    are filtered. ``reads`` names the columns that the filter of a fact uses; without it any may be used.
    """
    all_parts, all_measures = library
    groups = {f"group_{i}": tuple(name.split(".", 1)) for i, name in enumerate(group_by)}
    names = list(groups)
    parts = {p: all_parts[p] for m in measures for p in all_measures[m].parts}
    if hasattr(tables, "only"):
        tables = tables.only(columns_read(groups, parts, filters or (), reads), months="dim_date" in (filters or ()))

    def reached(p: Part) -> bool:
        return p.replaces not in group_by and all(related(p.table, owner) for owner, _ in groups.values())

    frames = []
    for table in dict.fromkeys(p.table for p in parts.values()):
        mine = {name: p for name, p in parts.items() if p.table == table and reached(p)}
        if mine:
            frames += _aggregate(tables, table, groups, filters or {}, mine)
    repeated = {name: p for name, p in parts.items() if not reached(p)}
    owners = {owner for owner, _ in groups.values()}
    if groups and (repeated and len(owners) == 1 or any(all_measures[m].never_blank for m in measures)):
        frames += _members(tables, groups, filters or {})
    if not frames:
        raise ValueError(f"no table of {sorted(repeated)} has a path to all groups: {sorted(owners)}")
    result = _fold(frames, names)
    for name, p in repeated.items():
        near = {g: v for g, v in groups.items() if related(p.table, v[0]) and p.replaces != ".".join(v)}
        part = _aggregate(tables, p.table, near, filters or {}, {name: p})[0]
        if not near:
            result = result.withColumn(name, part.scalar())
            continue
        side = part.select(*[F.col(g).alias(f"__{g}") for g in near], name)
        same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in near])
        result = result.join(side, same, "left").drop(*[f"__{g}" for g in near])

    values = [all_measures[m].value(*[F.col(p) for p in all_measures[m].parts]).alias(m) for m in measures]
    shown = result.select(*[F.col(g).alias(column) for g, (_, column) in groups.items()], *values)
    if groups:
        shown = shown.filter(F.coalesce(*[F.col(m).cast("string") for m in measures]).isNotNull())
    return shown
