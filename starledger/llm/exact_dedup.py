"""Exact duplicates by progressive refinement, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.common import Scratch, hash_filter, may_hold

# Blank runs that are not already one space; everything else is left where it is.
_UNEVEN = r"[\t-\r][\x20\t-\r]*|\x20[\x20\t-\r]+"


def normalised(text: str | Column) -> Column:
    """A text with every run of blanks as one space; NULL is the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("string"), _UNEVEN, " ")


def exact_duplicates(docs: DataFrame, prefix: int = 64, buckets: int = 1024, every_digest: bool = False) -> DataFrame:
    """Which documents repeat another one's text, blanks evened; the one with the smallest doc_id stays.

    Three levels, each deciding only what the one before left open. (1) Normalised lengths are counted; a
    length that occurs once ends its document's search. (2) Among equal lengths, hashes of the first ``prefix``
    characters are counted. (3) Only texts whose length and prefix occur more than once are digested (SHA-256)
    and grouped. Levels 1 and 2 are counts of 16-byte rows. What they leave is handed to level 3 as a bitmap
    of ``buckets`` x 4 KB (4 MB by default), the only thing broadcast; a text never leaves the task that reads
    it, and a bitmap too full for its input only means more digests, never another result.

    Rows: doc_id, n_chars (normalised), digest (NULL where level 1 or 2 decided, unless ``every_digest``),
    keep_id, group_size, kept, level (1, 2 or 3: which one decided).

    NULL texts are empty texts and so copies of each other. NULL doc_ids come after all others; with only
    those, keep_id is NULL. Rows that repeat a doc_id and its text are copies too: exactly one row of a group
    is kept. Very long texts are digested whole, as a stream. Other columns, whatever their names, are not
    read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised("text").alias("t"))
    sized = rows.select("doc_id", "t", F.length("t").alias("n"))
    counts = sized.groupBy("n", F.xxhash64(F.substring("t", 1, prefix)).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    counts = scratch.stage(counts)
    lengths = counts.groupBy("n").agg(F.sum("c").alias("c")).where("c > 1").select(F.xxhash64("n").alias("h"))
    prefixes = counts.where("c > 1").select(F.xxhash64("n", "p").alias("h"))
    by_length, by_prefix = scratch.stage(hash_filter(lengths, buckets)), scratch.stage(hash_filter(prefixes, buckets))
    open1 = may_hold(sized.withColumn("h", F.xxhash64("n")), by_length, "length_repeats", buckets)
    open1 = open1.withColumn("h", F.when(F.col("length_repeats"), F.xxhash64("n", F.xxhash64(F.substring("t", 1, prefix)))))
    open2 = may_hold(open1, by_prefix, "prefix_repeats", buckets)
    level = F.when(~F.col("length_repeats"), 1).when(~F.col("prefix_repeats"), 2).otherwise(3)
    digest = F.sha2(F.col("t").cast("binary"), 256)
    read = open2.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), digest.alias("digest") if every_digest else F.when(F.col("prefix_repeats"), digest).alias("digest"),
        level.alias("level"), F.monotonically_increasing_id().alias("copy"),
    )
    read = scratch.stage(read)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "copy")
    groups = read.where("level = 3").groupBy("digest").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
    # Staged so that the join below reads both sides from files and a hot text's rows can be split.
    groups = scratch.stage(groups.select(F.col("digest").alias("d"), F.col("first.doc_id").alias("keep_id"), F.col("first.copy").alias("keep"), "size"))
    out = read.join(groups, (F.col("level") == 3) & (F.col("digest") == F.col("d")), "left")
    alone = F.col("size").isNull()
    scratch.release(counts, by_length, by_prefix)
    return out.select(
        "doc_id", "n_chars", "digest", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("copy") == F.col("keep"))).alias("kept"), "level",
    )
