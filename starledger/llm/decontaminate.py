"""Benchmark decontamination by SimHash windows and weighted shingles, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.common import Scratch, row_hash, without

#: Fingerprint bits, blocks of the index, and the flips searched within a block: every fingerprint within
#: BLOCKS * (FLIPS + 1) - 1 bits has a block with at most FLIPS differing bits.
BITS, BLOCKS, FLIPS = 64, 8, 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
_WIDTH = BITS // BLOCKS
#: Fixed flips of a block: none, one bit, two bits.
_MASKS = [0] + [1 << i for i in range(_WIDTH)] + [1 << i | 1 << j for i in range(_WIDTH) for j in range(i)]


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; NULL and empty texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words, in order."""
    starts = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.expr("array()").cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))


def _fingerprint(rows: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash over the ``shingle`` rows of each key; a repeated shingle weighs more.

    One sum counts two bits, one in each half of it: a key has far fewer than 2^31 shingles. Half the sums are half
    the generated code, which the driver compiles and holds too.
    """
    half = BITS // 2
    pairs = [F.sum(F.shiftright(F.col("shingle"), i).bitwiseAND(F.lit(1 | 1 << half))).alias(f"b{i}") for i in range(half)]
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *pairs)
    ones = [F.col(f"b{i}").bitwiseAND(F.lit((1 << half) - 1)) for i in range(half)] + [F.shiftrightunsigned(f"b{i}", half) for i in range(half)]
    value = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft((2 * n > F.col("total")).cast("long"), i) for i, n in enumerate(ones)])
    return sums.select(*keys, "total", value.alias("print"))


def _block(value: Column, i: int) -> Column:
    return F.shiftrightunsigned(value, i * _WIDTH).bitwiseAND(F.lit(2**_WIDTH - 1)).cast("int")


def _indexed(items: DataFrame) -> DataFrame:
    """A row per item, block and flipped value: 8 times 37 rows per item."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("block"), _block(F.col("iprint"), i).alias("v")) for i in range(BLOCKS)]))
    blocks = items.select("item", "iprint", "isize", "itotal", pairs.alias("e"))
    return blocks.select("item", "iprint", "isize", "itotal", F.col("e.block").alias("block"), F.explode(F.array(*[F.col("e.v").bitwiseXOR(F.lit(m)) for m in _MASKS])).alias("v"))


def contaminated_windows(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Windows of documents that repeat a benchmark item: rows (doc_id, item_id, start, n_words, similarity, text_hash).

    A window has as many words as the item. Words are lower-cased runs of letters and digits. Its fingerprint
    is the SimHash of its ``words``-word shingles; fingerprints within ``RADIUS`` bits are found by blocks,
    each block of an item being indexed with all its values of at most ``FLIPS`` flipped bits, so none within
    the radius is missed. Candidates are verified exactly: the sum of smaller weights over the sum of larger
    weights of shingles, weight being how often the shingle occurs, must reach ``percent``.

    Only windows that can reach it get a fingerprint: their shingles that occur in the item must be enough
    for the shingles of both, the window being shorter at the end of a text.
    An item of fewer than ``words`` words is one shingle of its length; one without words matches nothing.
    The best window per document and item is returned, the first of ties. Items with equal words are found
    under each of their ids; a NULL item_id is an id too. Empty and NULL texts match nothing; documents that
    repeat doc_id and text are one. Empty tables give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    listed = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _words(F.col("text")).alias("w")).where(F.size("w") > 0)
    listed = scratch.stage(listed.select("item_id", F.xxhash64("w").alias("item"), F.size("w").alias("isize"), "w"))
    items = listed.dropDuplicates(["item"])
    short = [r[0] for r in items.where(F.col("isize") < words).select("isize").distinct().collect()]  # at most words - 1 numbers
    lengths = sorted({words, *short})

    def shingled(df: DataFrame, keys: list[str], own: Column | None = None) -> DataFrame:
        """A row per shingle with its length and position; ``own``: only the length an item has."""
        parts = []
        for k in lengths:  # one, unless the benchmark has items of fewer words
            part = df if own is None else df.where(own == k)
            part = part.select(*keys, F.lit(k).alias("k"), F.posexplode(_shingles(F.col("w"), k)).alias("at", "shingle"))
            parts.append(part)
        return reduce(DataFrame.unionByName, parts)

    own = F.least(F.col("isize"), F.lit(words))
    item_rows = scratch.stage(shingled(items, ["item", "isize"], own))
    prints = _fingerprint(item_rows, ["item", "isize"]).select("item", "isize", F.col("total").alias("itotal"), F.col("print").alias("iprint"))
    prints = scratch.stage(prints)
    weights = scratch.stage(item_rows.groupBy("item", "isize", "k", "shingle").agg(F.count(F.lit(1)).alias("iweight")))

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash("text").alias("text_hash"), "text")
    texts = keyed.select("doc_id", "text_hash", _words(F.col("text")).alias("w")).withColumn("n_words", F.size("w"))
    known = weights.select("k", "shingle").distinct()
    hits = shingled(texts, ["doc_id", "text_hash", "n_words"]).join(known, ["k", "shingle"], "left_semi").distinct()
    hits = scratch.stage(hits)

    # Every window start from which the item's words reach this hit; enough distinct positions must fall into it.
    # A window that the end of the text cuts short has fewer shingles and needs fewer of them.
    inner = F.least("isize", F.col("n_words") - F.col("start")) - F.col("k") + 1
    enough = (100 + percent) * F.col("found") >= percent * (F.col("isize") - F.col("k") + 1 + inner)
    matched = hits.join(weights.select("item", "isize", "k", "shingle"), ["k", "shingle"])
    starts = matched.select("doc_id", "text_hash", "n_words", "item", "isize", "k", F.explode(F.sequence(F.greatest(F.lit(0), F.col("at") - (F.col("isize") - F.col("k"))), F.col("at"))).alias("start"))
    windows = starts.groupBy("doc_id", "text_hash", "n_words", "item", "isize", "k", "start").agg(F.count(F.lit(1)).alias("found")).where(enough)
    sized = scratch.stage(windows.select("doc_id", "text_hash", "isize", "k", "start").distinct())

    flagged = sized.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    again = keyed.join(flagged, same, "left_semi").dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", _words(F.col("text")).alias("w"))
    again = scratch.stage(again)
    inside = again.alias("d").join(sized.alias("s"), F.expr("d.doc_id <=> s.doc_id and d.text_hash = s.text_hash")).select(
        "d.doc_id", "d.text_hash", "isize", "k", "start", F.slice("w", F.col("start") + 1, F.col("isize")).alias("w"),
    )
    key = ["doc_id", "text_hash", "isize", "start"]
    shingles = scratch.stage(shingled(inside.withColumnRenamed("k", "own"), [*key, "own"], F.col("own")).drop("own"))
    marked = _fingerprint(shingles, key)

    blocks = F.explode(F.array(*[F.struct(F.lit(i).alias("block"), _block(F.col("print"), i).alias("v")) for i in range(BLOCKS)])).alias("e")
    seen = marked.select(*key, "total", "print", blocks).select(*key, "total", "print", "e.*")
    near = seen.join(_indexed(prints), ["block", "v", "isize"])
    near = near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("iprint"))) <= RADIUS).select(*key, "item", "total", "itotal").distinct()

    counts = shingles.groupBy(*key, "k", "shingle").agg(F.count(F.lit(1)).alias("weight"))
    ids = F.expr("n.doc_id <=> c.doc_id and n.text_hash = c.text_hash and n.isize = c.isize and n.start = c.start")
    both = near.alias("n").join(counts.alias("c"), ids).select("n.*", "c.k", "c.shingle", "c.weight").join(weights.drop("isize"), ["item", "k", "shingle"])
    smaller = both.groupBy(*key, "item", "total", "itotal").agg(F.sum(F.least("weight", "iweight")).alias("smaller"))
    judged = smaller.withColumn("larger", F.col("total") + F.col("itotal") - F.col("smaller")).where(100 * F.col("smaller") >= percent * F.col("larger"))
    best = judged.groupBy("doc_id", "text_hash", "item", "isize").agg(F.max_by(F.struct("start", "smaller", "larger"), F.struct(F.col("smaller") / F.col("larger"), -F.col("start"))).alias("best"))
    named = best.join(listed.select("item_id", "item"), "item")
    return named.select("doc_id", "item_id", F.col("best.start").cast("long").alias("start"), F.col("isize").cast("long").alias("n_words"), (F.col("best.smaller") / F.col("best.larger")).alias("similarity"), "text_hash")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents in which a window repeats an item of ``benchmark``; all columns stay."""
    bad = contaminated_windows(docs, benchmark, **options).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    return without(docs, bad, row_hash("text"), Scratch(docs.sparkSession, "windows_kept"))
