"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starledger.llm.common import Scratch, dense_rank


def interleave(docs: DataFrame, shards: int = 24, stratum: str = "source", seed: str = "shards") -> DataFrame:
    """Shards of equal row counts (at most one apart) that each match the mixture of ``stratum``.

    Rows are shuffled within each stratum by a seeded digest of doc_id and numbered; the order of all rows is
    by fractional rank (number + 1/2) / size of the stratum, ties by digest; shard s takes the s-th of
    ``shards`` equal cuts. Rows: doc_id, size (UTF-8 bytes plus 8), text_crc32, law, shard, slot (0.. in its
    shard), grown_shard (NULL: the law is ``rows``), copy.

    Both orders are ranges of narrow rows without the text; ranges are shifted by the sizes of those before,
    so no stratum meets in one task. NULL texts count as empty, NULL strata are a stratum. Equal doc_ids are
    told apart by text and then by place, so repeated rows get slots of their own. With fewer rows than
    shards, some shards are empty. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))).alias("mix"), F.monotonically_increasing_id().alias("copy"),
    )
    rows = scratch.stage(rows)
    ranked = scratch.stage(dense_rank(rows, ["stratum", "mix", "text_crc32", "size", "copy"], "at", scratch))
    strata = ranked.groupBy("stratum").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("members"))
    strata = strata.select(F.col("stratum").alias("__s"), "low", "members")
    share = (2 * (F.col("at") - F.col("low")) + 1) / (2 * F.col("members"))
    mixed = ranked.join(strata, F.col("stratum").eqNullSafe(F.col("__s"))).withColumn("share", share).drop("__s", "low", "members", "at")
    placed = dense_rank(mixed, ["share", "mix", "stratum", "text_crc32", "size", "copy"], "place", scratch)
    total = rows.count()
    shard = F.expr(f"cast(cast(place as decimal(20,0)) * {shards} div {max(total, 1)} as int)")
    # The first place of a shard is the smallest p with p * shards div total = shard.
    first = F.expr(f"(cast(shard as decimal(20,0)) * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("place") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "copy",
    )
