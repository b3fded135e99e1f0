"""Pages of records, already fetched, put together into one set of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starledger.session import stage


def _chains(pages: DataFrame, chain: Sequence[str]) -> DataFrame:
    """The pages up to the last one of their chain: the first one without a next cursor.

    Chains are told apart by the columns ``chain``. Only the cursor is parsed to find the last pages; their
    minimum per chain is combined before the shuffle and joined back.
    """
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(f"__k{i}") for i, c in enumerate(chain)] or [F.lit("").alias("__k0")]
    names = [f"__k{i}" for i in range(len(keys))]
    cursor = F.coalesce(F.from_json("body", "cursor string")["cursor"], F.lit(""))
    last = pages.where(cursor == "").select(*keys, "page_no").groupBy(*names).agg(F.min("page_no").alias("__last"))
    kept = pages.withColumns({n: k for n, k in zip(names, keys, strict=True)}).join(last, names, "left")
    return kept.where(F.col("__last").isNull() | (F.col("page_no") <= F.col("__last"))).select(*chain, "page_no", "body")


def merge_pages(pages: DataFrame, records_field: str, record_type: str, chain: Sequence[str] = ()) -> DataFrame:
    """Records of cursor-linked pages, as ``(*chain, page_no, position, record)``.

    ``pages`` holds ``page_no``, ``body`` (the JSON text of a page) and the columns ``chain`` that name a
    source; without any, all pages are one chain. Pages of a chain after its first one without a cursor are
    not part of it; a chain without such a page is taken whole. A page without its record array is empty.
    """
    records = F.from_json("body", f"{records_field} array<{record_type}>")[records_field]
    return _chains(pages, chain).select(*chain, "page_no", F.posexplode(records).alias("position", "record"))


def page_report(pages: DataFrame, records_field: str, record_type: str, chain: Sequence[str] = ()) -> DataFrame:
    """Pages in each chain and records in them; one row for one chain."""
    size = F.coalesce(F.size(F.from_json("body", f"{records_field} array<{record_type}>")[records_field]), F.lit(0))
    return _chains(pages, chain).groupBy(*chain).agg(
        F.count("*").alias("pages"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("records")
    )


def _chain_key(chain: Sequence[str]) -> Column:
    """The columns of a chain as one text; NULL is not the empty text."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(chain)])) if chain else F.lit("")


def _cursor(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def link_pages(pages: DataFrame, chain: Sequence[str] = (), asked: str = "asked", cursor: str = "cursor") -> DataFrame:
    """Number pages by following their cursors: ``(*chain, page_no, next_no, next_cursor, deliveries, body)``.

    ``pages`` holds ``body`` (the JSON text of a page, with the ``cursor`` of the page after it), ``asked`` (the
    cursor the page was asked for with; NULL or empty for a first page) and the columns ``chain`` that name a source.
    No page number is needed: a page follows the one whose cursor it was asked for with. ``page_no`` counts from 1
    and is NULL for pages that no path from a first page reaches. ``next_no`` is the number of the following
    page: NULL after the last one and where that page was never delivered (a gap), not above ``page_no`` where the
    cursors run in a loop. Of a page delivered several times one is kept.

    Links are followed by pointer doubling: in each round every page knows the page twice as far ahead, and the
    numbered pages of each chain double. A chain of n pages takes about log2 n rounds of joins between narrow
    rows of two numbers, however many chains there are, and only a row count per round reaches the driver.
    """
    following = F.from_json("body", f"{cursor} string")[cursor]
    given = pages.select(
        *chain, _chain_key(chain).alias("__chain"), _cursor(F.col(asked)).alias("__asked"), _cursor(following).alias("__next"),
        F.monotonically_increasing_id().alias("__id"), "body",
    )
    given = stage(given, "pages")
    first = F.struct(F.xxhash64("body").alias("h"), F.col("__id").alias("id"), F.col("__next").alias("next"))
    one = given.groupBy("__chain", "__asked").agg(F.min(first).alias("p"), F.count("*").alias("deliveries"))
    one = stage(one.select("__chain", "__asked", "p.id", F.col("p.next").alias("next"), "deliveries"), "page-links")
    target = one.select("__chain", F.col("__asked").alias("next"), F.col("id").alias("to"))
    links = stage(one.filter("next <> ''").select("__chain", "next", "id").join(target, ["__chain", "next"]).select("id", "to"), "page-links")
    numbered = stage(one.filter("__asked = ''").select("id", F.lit(1).cast("long").alias("page_no")), "page-numbers")
    ahead, step, known = links, 1, numbered.count()
    while True:
        found = numbered.join(ahead, "id").select(F.col("to").alias("id"), (F.col("page_no") + step).alias("page_no"))
        numbered = stage(numbered.unionAll(found).groupBy("id").agg(F.min("page_no").alias("page_no")), "page-numbers")
        now = numbered.count()
        if now == known:
            break
        known, step = now, 2 * step
        further = ahead.select(F.col("id").alias("to"), F.col("to").alias("further"))
        ahead = stage(ahead.join(further, "to").select("id", F.col("further").alias("to")), "page-links")
    after = links.join(numbered.select(F.col("id").alias("to"), F.col("page_no").alias("next_no")), "to").select("id", "next_no")
    placed = one.select("id", "deliveries", "next").join(numbered, "id", "left").join(after, "id", "left").withColumnRenamed("id", "__id")
    return given.join(placed, "__id").select(*chain, "page_no", "next_no", F.col("next").alias("next_cursor"), "deliveries", "body")


def merge_linked_pages(linked: DataFrame, records_field: str, record_type: str, chain: Sequence[str] = ()) -> DataFrame:
    """Records of the pages that :func:`link_pages` numbered, as :func:`merge_pages` gives them."""
    reached = linked.filter(F.col("page_no").isNotNull()).select(*chain, "page_no", "body")
    return merge_pages(reached, records_field, record_type, chain)


def link_report(linked: DataFrame, records_field: str, record_type: str, chain: Sequence[str] = ()) -> DataFrame:
    """What following the cursors of each chain gave.

    Pages and records reached, pages left aside, pages delivered again, and how the chain ends: ``complete`` with a
    page without a cursor, ``gap`` before a page that is missing (its cursor is in ``missing``), ``loop`` back to
    an earlier page, ``no first page``.
    """
    reached = F.col("page_no").isNotNull()
    size = F.coalesce(F.size(F.from_json("body", f"{records_field} array<{record_type}>")[records_field]), F.lit(0))
    gap = reached & (F.col("next_cursor") != "") & F.col("next_no").isNull()
    totals = linked.groupBy(*chain).agg(
        F.count_if(reached).alias("pages"),
        F.coalesce(F.sum(F.when(reached, size)), F.lit(0)).cast("long").alias("records"),
        F.count_if(~reached).alias("unreached"),
        F.sum(F.col("deliveries") - 1).cast("long").alias("repeated"),
        F.min(F.when(gap, F.col("next_cursor"))).alias("missing"),
        F.count_if(F.col("next_no") <= F.col("page_no")).alias("loops"),
    )
    ends = F.when(F.col("pages") == 0, "no first page").when(F.col("loops") > 0, "loop").when(F.col("missing").isNotNull(), "gap")
    return totals.select(*chain, "pages", "records", "unreached", "repeated", ends.otherwise("complete").alias("ends"), "missing")
