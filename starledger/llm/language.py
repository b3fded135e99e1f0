"""Language identification by Bayesian fusion of text, markup, address and host evidence."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.common import Scratch, bounded_sample, row_hash
from starledger.llm.html_consensus import main_text, parse

BUCKETS = 8192
#: Languages that country endings of host names suggest.
ENDINGS = {
    "de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "cl": "es", "co": "es", "uk": "en", "us": "en", "ie": "en", "au": "en", "nz": "en",
    "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "cn": "zh", "jp": "ja", "kr": "ko", "se": "sv", "dk": "da", "no": "nb", "fi": "fi", "cz": "cs",
}


def trigrams(text: str) -> np.ndarray:
    """Hashed character trigrams of the whole lower-cased text, white space as one space."""
    c = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    h = c[:-2] * np.uint64(0x9E3779B97F4A7C15) + c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[2:] * np.uint64(0x165667B19E3779F9)
    return ((h >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)


def fit_text_model(labelled: DataFrame, sample: int = 3000, most: int = 64) -> tuple[list[str], np.ndarray]:
    """Languages and log trigram probabilities (buckets x languages), from a bounded sample of labelled rows.

    The ``sample`` whole texts of smallest hash are counted by Spark per language and bucket, so at most
    ``most`` x 8192 counts reach the driver; the ``most`` most frequent languages of the sample are known.
    """
    rows = labelled.select(F.lower(F.col("lang").cast("string")).alias("lang"), F.col("text").cast("string").alias("text"), row_hash("doc_id", "text").alias("h"))
    rows = rows.where("lang is not null and lang <> '' and text <> ''")
    picked = bounded_sample(rows, labelled.count(), sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                b, n = np.unique(trigrams(text.as_py()), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(b), pa.string()), pa.array(b), pa.array(n)], ["lang", "b", "n"])

    counts = picked.select("lang", "text").mapInArrow(count, "lang string, b long, n long").groupBy("lang", "b").agg(F.sum("n").alias("n"))
    top = counts.groupBy("lang").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "lang").limit(most)
    found = counts.join(F.broadcast(top), "lang").select("lang", "b", "n").collect()
    langs = sorted({r.lang for r in found}) or ["und"]
    table = np.full((BUCKETS, len(langs)), 0.05)
    for r in found:
        table[r.b, langs.index(r.lang)] += r.n
    return langs, np.log(table / table.sum(0)).astype(np.float32)


def _text_evidence(model: np.ndarray, weight: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column("html"):
                t = trigrams(main_text(parse(x.as_py() or ""), [])[0])
                score = np.bincount(t, minlength=BUCKETS).astype(np.float32) @ model if len(t) else np.zeros(model.shape[1])
                # Trigrams of one text depend on each other: all together count as ``weight`` at most.
                score = score.astype(float) * min(1.0, weight / max(len(t), 1))
                out.append(np.round(score - score.max(), 6).tolist())
            columns = [batch.column(c) for c in ("page_id", "url", "host", "domain", "declared", "suffix")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.list_(pa.float64()))], ["page_id", "url", "host", "domain", "declared", "suffix", "loglik"])

    return run


def _normal(weights: Column) -> Column:
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def _softmax(scores: Column) -> Column:
    return _normal(F.transform(scores, lambda x: F.exp(x - F.array_max(scores))))


def identify(pages: DataFrame, labelled: DataFrame, weight: int = 40, smoothing: float = 5.0, sample: int = 3000) -> DataFrame:
    """The language of every page: rows (page_id, url, declared, suffix, text_lang, lang, confidence).

    Log evidence is added per language: tempered trigram likelihood of the main text; how often pages of the
    language declare what this one does (markup language, with "none" and "other"); likewise the country
    ending of the host or the language segment of the path; and the host's prior, smoothed towards its
    domain's, smoothed towards the global one, without the page itself. The last three are counted over all
    pages by grouped aggregation of text posteriors. ``confidence`` is the posterior of ``lang``.

    Pages without text or markup are judged by the remaining evidence. NULL urls share an empty host. Ties go
    to the first language by code. Repeated rows are judged alike. Without labelled rows the language is
    "und". An empty table gives no rows.
    """
    scratch = Scratch(pages.sparkSession, "language")
    langs, model = fit_text_model(labelled, sample)
    url, text = F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    known = F.array(*map(F.lit, langs))
    said = F.lower(F.regexp_extract(text, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})\b""", 1))
    declared = F.when(said == "", "none").when(F.array_contains(known, said), said).otherwise("other")
    ending = F.create_map(*[F.lit(x) for pair in ENDINGS.items() for x in pair])[F.substring_index(host, ".", -1)]
    segment = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:]*://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    named = F.when(F.array_contains(known, ending), ending).when(F.array_contains(known, segment), segment)
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host.alias("host"), F.substring_index(host, ".", -2).alias("domain"),
        declared.alias("declared"), F.coalesce(named, F.lit("none")).alias("suffix"), text.alias("html"),
    )
    schema = "page_id long, url string, host string, domain string, declared string, suffix string, loglik array<double>"
    seen = narrow.mapInArrow(_text_evidence(model, weight), schema).withColumn("posterior", _softmax(F.col("loglik")))
    seen = scratch.stage(seen)
    k = range(len(langs))
    sums = [F.sum(F.col("posterior")[i]).alias(f"p{i}") for i in k]

    # At most (languages + 2) rows each: what is declared is a known language, "other" or "none".
    overall = seen.agg(*sums).first()
    total = [float(overall[i] or 0.0) for i in k]

    def reliability(column: str) -> Column:
        values = seen.groupBy(column).agg(*sums).collect()
        kinds = len(values) + 1
        rows = {r[0]: [float(np.log((r[i + 1] + 1.0) / (total[i] + kinds))) for i in k] for r in values}
        pairs = [x for v, logs in rows.items() for x in (F.lit(v), F.array(*map(F.lit, logs)))]
        return F.create_map(*pairs)[F.col(column)] if pairs else F.array(*[F.lit(0.0)] * len(langs))

    everywhere = [(t + 1.0) / (sum(total) + len(langs)) for t in total]
    domains = seen.groupBy("domain").agg(*[s.alias(f"d{i}") for i, s in zip(k, sums, strict=True)])
    hosts = seen.groupBy("host", "domain").agg(*[s.alias(f"h{i}") for i, s in zip(k, sums, strict=True)])
    priors = hosts.join(domains, "domain").select("host", F.array(*[f"h{i}" for i in k]).alias("host_sum"), F.array(*[f"d{i}" for i in k]).alias("domain_sum"))
    priors = scratch.stage(priors)

    def smoothed(sums: str, above: Column) -> Column:
        others = F.zip_with(F.col(sums), F.col("posterior"), lambda s, own: F.greatest(s - own, F.lit(0.0)))
        n = F.aggregate(others, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(others, above, lambda s, p: (s + smoothing * p) / (n + smoothing))

    prior = smoothed("host_sum", smoothed("domain_sum", F.array(*map(F.lit, everywhere))))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = reduce(add, [F.col("loglik"), reliability("declared"), reliability("suffix"), F.transform(prior, lambda p: F.log(F.greatest(p, F.lit(1e-12))))])
    judged = seen.join(priors, "host").withColumn("fused", _softmax(fused))
    best = lambda c: F.get(known, F.array_position(F.col(c), F.array_max(c)).cast("int") - 1)
    return judged.select("page_id", "url", "declared", "suffix", best("loglik").alias("text_lang"), best("fused").alias("lang"), F.array_max("fused").alias("confidence"))
