"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from starledger.llm import (
    decontaminate, exact_dedup, hard_negatives, html_consensus, infill, language, log_templates, mixing, neardup, quality, sharding, tokens,
)
from starledger.llm.common import Scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents")).drop("row_hash")


@query
def op2_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.calibrated(table(spark, sf_dir, "documents")).drop("row_hash")


@query
def op3_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.main_texts(table(spark, sf_dir, "pages"))


@query
def op4_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents")).drop("copy")


@query
def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85).drop("text_hash")


@query
def op6_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


@query
def op7_bit_plane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{Scratch(spark, 'id_files').root}/ids"
    tokens.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return tokens.read_ids(spark, folder)


@query
def op8_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_log_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = log_templates.drop_templates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return cut.select("doc_id", "n_lines", "n_dropped", F.length(text).cast("long").alias("n_chars"), F.crc32(text.cast("binary")).alias("text_crc32"))


@query
def op11_residue_gemm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


@query
def op12_progressive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), every_digest=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query
def op13_wavelet_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(infill.restored()).alias("restored_sha256"),
    )


ORACLES["op11_residue_gemm"] = """WITH e AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  a AS (SELECT * FROM e WHERE vec_id % 50 = 0),
  s AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
    FROM a JOIN e ON a.vec_id <> e.vec_id),
  p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
  n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score FROM p JOIN s USING (anchor_id)
    WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
  SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
  WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id)
  QUALIFY row_number() OVER w <= 3"""

ORACLES["op12_progressive_dedup"] = r"""WITH d AS (SELECT doc_id,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
  SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256 FROM d
  WINDOW g AS (PARTITION BY text_sha256)"""

ORACLES["op13_wavelet_infill"] = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
  u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
  k AS (SELECT *, len(units) AS n, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain FROM u),
  c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM k),
  s AS (SELECT doc_id, t, n, plain, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:n], '') AS s FROM c)
  SELECT doc_id, n, form, CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM s"""

# CRC-32 over the bytes of a text, by the table of the reflected polynomial 0xEDB88320.
ORACLES["op4_interleaved_shards"] = """WITH cells AS (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)),
  crc AS (SELECT list(c ORDER BY i) AS t FROM cells),
  raw AS (SELECT doc_id, source, strlen(coalesce(text, '')) + 8 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
  bytes AS (SELECT doc_id, source, size,
    list_transform(range(size - 8), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS b FROM raw),
  docs AS (SELECT doc_id, source, size, md5('shards:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS mix,
    xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
    FROM bytes, crc),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY mix, text_crc32, size) AS r,
    count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM docs),
  placed AS (SELECT *, row_number() OVER (ORDER BY CAST(2 * r - 1 AS DOUBLE) / CAST(2 * n AS DOUBLE), mix,
    source NULLS FIRST, text_crc32, size) - 1 AS p FROM ranked)
  SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
  CAST(p * 24 // total AS INTEGER) AS shard, CAST(p - ((p * 24 // total) * total + 23) // 24 AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard FROM placed"""
