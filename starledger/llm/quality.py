"""Quality rules by robust multivariate outliers: minimum covariance determinants per language and source."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.common import Scratch, kept_only, row_hash

FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats")
D = len(FEATURES)
#: Smallest scale of each transformed statistic: below it a spread says nothing about quality.
FLOORS = (1.0, 0.05, 0.02, 0.1, 0.1)
#: Quantiles of the chi-square distribution with five degrees of freedom: 0.5, 0.975 and 0.9999.
CHI_HALF, CHI_975, CHI_9999 = 4.3515, 12.8325, 25.7448
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
_BINS_PER_OCTAVE = 8


def text_statistics(raw: bytes | None) -> tuple[int, int, int, int, int, int]:
    """The base statistics of one whole text (UTF-8); no text gives zeros."""
    if not raw:
        return 0, 0, 0, 0, 0, 0
    words = raw.split()
    n = len(words)
    continued = np.frombuffer(raw, np.int8) < -64  # bytes 0x80 to 0xBF continue a code point
    chars = len(raw) - int(continued.sum()) - (len(raw) - len(raw.translate(None, b" \t\n\x0b\x0c\r")))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    seen: set[bytes] = set()
    dup = lines = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
            lines += 1
        elif line.strip():
            seen.add(line)
            lines += 1
    repeat = 0
    if n >= 3:
        first: dict[bytes, int] = {}
        ids = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
        two = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        _, where, counts = np.unique(two[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
        again = counts[where] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= again
        repeat = int(covered.sum())
    return n, chars, symbols, dup, repeat, lines


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("__text").cast(pa.binary())
        found = np.array([text_statistics(t.as_py()) for t in text], np.int64).reshape(-1, 6)
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        names = [f.name for f in batch.schema][:-1] + [c.split()[0] for c in STATS.split(", ")]
        yield pa.RecordBatch.from_arrays(kept + [pa.array(found[:, i]) for i in range(6)], names)


def _fixed(c: Column) -> Column:
    """Rounded to 2**-10, so that sums of products are exact and independent of order in any sensible group."""
    return F.round(c * 1024) / 1024


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, source, row hash, base statistics and transformed statistics f0..f4."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        row_hash("doc_id", "text", "lang", "source").alias("row_hash"), F.col("text").cast("string").alias("__text"),
    )
    rows = narrow.mapInArrow(_statistics, f"doc_id long, lang string, source string, row_hash long, {STATS}")
    words = F.greatest("n_words", F.lit(1))
    features = (
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / words),
        F.log1p(F.col("n_symbols") / words),
        F.log1p(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        F.log1p(F.col("n_repeat_words") / words),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("*", failed.alias("base_failed"), *[_fixed(f).alias(f"f{i}") for i, f in enumerate(features)])


def _groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """The estimate each (language, source) takes: its own, or its language's small sources pooled, or all small ones, or the whole table's."""
    n = rows.groupBy("lang", "source").agg(F.sum((~F.col("base_failed")).cast("long")).alias("count"))
    star = F.lit("*")
    small = F.col("count") < min_rows
    n = n.withColumn("g1", F.when(small, F.struct(F.lit(1).alias("level"), F.coalesce("lang", star).alias("l"), star.alias("s"))).otherwise(F.struct(F.lit(0).alias("level"), F.coalesce("lang", star).alias("l"), F.coalesce("source", star).alias("s"))))
    pooled = n.groupBy("g1").agg(F.sum("count").alias("pooled"))
    wide = F.struct(F.lit(2).alias("level"), star.alias("l"), star.alias("s"))
    n = n.join(pooled, "g1").withColumn("g2", F.when(F.col("pooled") < min_rows, wide).otherwise(F.col("g1")))
    last = n.groupBy("g2").agg(F.sum("count").alias("last"))
    whole = F.struct(F.lit(3).alias("level"), star.alias("l"), star.alias("s"))
    n = n.join(last, "g2").withColumn("g", F.when(F.col("last") < min_rows, whole).otherwise(F.col("g2")))
    return n.select("lang", "source", F.concat_ws("\x1f", "g.level", "g.l", "g.s").alias("g"))


def _whiten(mean: np.ndarray, cov: np.ndarray) -> tuple[list[float], list[float], float]:
    """Mean, lower inverse Cholesky factor by rows, and log determinant; the floors keep any group regular."""
    cov = cov + np.diag(np.square(FLOORS))
    low = np.linalg.cholesky(cov)
    inverse = np.linalg.inv(low)
    return mean.tolist(), [float(inverse[i, j]) for i, j in PAIRS], float(2 * np.log(np.diag(low)).sum())


def _moments(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, sums = total[0], total[1 : 1 + D]
    mean, cov = sums / n, np.zeros((D, D))
    for k, (i, j) in enumerate(PAIRS):
        cov[i, j] = cov[j, i] = total[1 + D + k] / n - mean[i] * mean[j]
    return mean, cov


#: The estimate over all documents, for those whose pool stays too small.
WHOLE = "3\x1f*\x1f*"
ESTIMATE = "g string, start int, mean array<double>, white array<double>, logdet double, scale double, n long"


def _centres(pdf: pd.DataFrame) -> pd.DataFrame:
    """Median and median absolute deviation per statistic from counts per 1/64."""
    mean, spread = np.zeros(D), np.zeros(D)
    for j, part in pdf.groupby("j"):
        x, n = part["bin"].to_numpy() / 64.0, part["n"].to_numpy()

        def middle(v: np.ndarray, n: np.ndarray = n) -> float:
            order = np.argsort(v, kind="stable")
            return float(v[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)])

        mean[j] = middle(x)
        spread[j] = max(1.4826 * middle(np.abs(x - mean[j])), FLOORS[j])
    m, w, logdet = _whiten(mean, np.diag(spread**2))
    return pd.DataFrame({"g": [pdf["g"].iloc[0]], "start": [0], "mean": [m], "white": [w], "logdet": [logdet], "scale": [1.0], "n": [int(pdf["n"].sum() // D)]})


def _starts(pdf: pd.DataFrame) -> pd.DataFrame:
    """The diagonal start, and the starts from correlations of tanh scores and of spatial signs."""
    row = pdf.iloc[0]
    mean, spread = np.array(row["mean"]), 1 / np.array([row["white"][PAIRS.index((i, i))] for i in range(D)])
    out = [(0, row["mean"], row["white"], row["logdet"])]
    for start, kind in ((1, "tanh"), (2, "sign")):
        _, cov = _moments(np.array([row[f"{kind}{k}"] for k in range(1 + D + len(PAIRS))], float))
        unit = np.sqrt(np.maximum(np.diag(cov), 1e-3))
        out.append((start, *_whiten(mean, cov / np.outer(unit, unit) * np.outer(spread, spread))))
    return pd.DataFrame([(row["g"], s, list(m), list(w), d, 1.0, int(row["n"])) for s, m, w, d in out], columns=["g", "start", "mean", "white", "logdet", "scale", "n"])


def _concentrate(share: float | None):
    """Mean and covariance of the closest part: a share of the rows, or all within the 0.975 quantile."""

    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n = pdf["s0"].to_numpy()
        upper = np.exp2((pdf["bin"].to_numpy() + 1) / _BINS_PER_OCTAVE)
        running = np.cumsum(n)
        scale = float(upper[np.searchsorted(running, running[-1] / 2)]) / CHI_HALF
        last = int(np.searchsorted(running, np.ceil(share * running[-1]))) if share else max(int((upper <= CHI_975 * scale).sum()) - 1, 0)
        total = pdf[[f"s{k}" for k in range(1 + D + len(PAIRS))]].to_numpy(float)[: last + 1].sum(0)
        m, w, logdet = _whiten(*_moments(total))
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "start": [int(pdf["start"].iloc[0])], "mean": [m], "white": [w], "logdet": [logdet], "scale": [scale], "n": [int(running[-1])]})

    return step


def _scaled(pdf: pd.DataFrame) -> pd.DataFrame:
    """The scale at which the median squared distance is the one of the model; never below 1, else the floors would not hold."""
    pdf = pdf.sort_values("bin")
    running = np.cumsum(pdf["s0"].to_numpy())
    at = np.searchsorted(running, running[-1] / 2)
    return pd.DataFrame({"g": [pdf["g"].iloc[0]], "scale": [max(1.0, float(np.exp2((pdf["bin"].iloc[at] + 1) / _BINS_PER_OCTAVE)) / CHI_HALF)]})


def _x(i: int) -> Column:
    return F.col(f"f{i}")


def _squared_distance() -> Column:
    white = {p: F.col("white")[k] for k, p in enumerate(PAIRS)}
    parts = [reduce(lambda a, b: a + b, [white[i, j] * (_x(j) - F.col("mean")[j]) for j in range(i + 1)]) for i in range(D)]
    return reduce(lambda a, b: a + b, [p * p for p in parts])


def _sums(v: list[Column], name: str) -> list[Column]:
    values = [F.lit(1.0), *v, *[v[i] * v[j] for i, j in PAIRS]]
    return [F.sum(c).alias(f"{name}{k}") for k, c in enumerate(values)]


def _binned(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Moments per estimate and bin of log distance: a few hundred rows per estimate, combined before the shuffle."""
    bins = F.floor(F.log2(_squared_distance() + 2.0**-10) * _BINS_PER_OCTAVE).cast("int")
    return rows.join(estimates.drop("n"), "g").withColumn("bin", bins).groupBy("g", "start", "bin").agg(*_sums([_x(i) for i in range(D)], "s"))


def estimate(rows: DataFrame, scratch: Scratch, share: float = 0.75, steps: int = 4) -> DataFrame:
    """A reweighted minimum covariance determinant estimate per group ``g`` of ``rows``.

    Deterministic starts (robust diagonal, tanh and spatial-sign correlations), then concentration steps
    over all rows. Each step is one aggregation: moments per bin of log distance give the mean and covariance
    of the closest ``share`` of a group, rounded up to a whole bin. The start of least determinant is kept
    and reweighted once. Only groups times a few hundred bins leave the rows' tasks.
    """
    bins = rows.select("g", F.posexplode(F.array(*[F.floor(_x(i) * 64).cast("long") for i in range(D)])).alias("j", "bin")).groupBy("g", "j", "bin").agg(F.count(F.lit(1)).alias("n"))
    now = scratch.stage(bins.groupBy("g").applyInPandas(_centres, ESTIMATE))
    unit = [F.col("white")[PAIRS.index((i, i))] * (_x(i) - F.col("mean")[i]) for i in range(D)]
    length = F.greatest(F.sqrt(reduce(lambda a, b: a + b, [u * u for u in unit])), F.lit(1e-6))
    scores = rows.join(now, "g").groupBy("g").agg(*_sums([F.tanh(u) for u in unit], "tanh"), *_sums([u / length for u in unit], "sign"))
    used, now = now, scratch.stage(now.join(scores, "g").groupBy("g").applyInPandas(_starts, ESTIMATE))
    scratch.release(used)
    for _ in range(steps):
        used, now = now, scratch.stage(_binned(rows, now).groupBy("g", "start").applyInPandas(_concentrate(share), ESTIMATE))
        scratch.release(used)
    best = now.groupBy("g").agg(F.min_by(F.struct("start", "mean", "white", "logdet", "scale", "n"), F.struct("logdet", "start")).alias("best")).select("g", "best.*")
    used, now = now, scratch.stage(_binned(rows, best).groupBy("g", "start").applyInPandas(_concentrate(None), ESTIMATE))
    scratch.release(used)
    scales = _binned(rows, now).groupBy("g").applyInPandas(_scaled, "g string, scale double")
    return scratch.stage(now.drop("scale").join(scales, "g"))


def quality_verdicts(docs: DataFrame, cutoff: float = CHI_9999, min_rows: int = 200, share: float = 0.75, steps: int = 4) -> DataFrame:
    """One row per document with its statistics, ``base_failed``, robust distance and ``kept``.

    Documents that pass the base rules are fitted; ``kept`` is false for base failures and where the squared
    robust distance of the five transformed statistics exceeds ``cutoff``. Sources with fewer than
    ``min_rows`` documents share their language's estimate of small sources, and those too few share one
    over all small ones. Where that too has fewer than ``min_rows`` rows, the estimate is fitted on all passing
    documents of the table, however few, so every document has a distance if any passes the base rules.

    NULL or empty texts have zero statistics and fail the base rules. NULL languages and sources are groups
    of their own. Repeated rows are judged like any other. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.stage(statistics(docs))
    groups = scratch.stage(_groups(rows, min_rows))
    keyed = rows.join(groups.select(F.col("lang").alias("__l"), F.col("source").alias("__s"), "g"), F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s")), "left").drop("__l", "__s")
    good = keyed.where(~F.col("base_failed"))
    if not groups.where(F.col("g") == WHOLE).isEmpty():
        good = good.where(F.col("g") != WHOLE).unionByName(good.withColumn("g", F.lit(WHOLE)))
    found = estimate(good, scratch, share, steps)
    judged = keyed.join(found.select("g", "mean", "white", "scale"), "g", "left")
    distance = _squared_distance() / F.col("scale")
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)
    return judged.withColumn("distance", distance).select(
        "doc_id", "lang", "source", "row_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance",
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that :func:`quality_verdicts` rejects; all columns stay as they are."""
    decided = quality_verdicts(docs, **options).select(F.col("doc_id").alias("__id"), F.col("row_hash").alias("__hash"), "kept")
    return kept_only(docs, decided, row_hash("doc_id", "text", "lang", "source"), Scratch(docs.sparkSession, "quality_kept"))
