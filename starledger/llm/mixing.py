"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from starledger.llm.common import Scratch, kept_only, row_hash

BUCKETS = 1024
MARGINS = ("source", "lang", "topic")
#: Stands for NULL in the cells.
_NONE = "\x00"
_BUCKET: dict[bytes, int] = {}


def word_vector(raw: bytes | None) -> tuple[int, np.ndarray]:
    """Number of words of a whole text, and its damped hashed word counts at length 1."""
    words = raw.lower().split() if raw else []
    if len(_BUCKET) > 100_000:
        _BUCKET.clear()
    for w in set(words).difference(_BUCKET):
        _BUCKET[w] = xxhash.xxh3_64_intdigest(w) % BUCKETS
    counts = np.log1p(np.bincount(np.fromiter(map(_BUCKET.__getitem__, words), np.int64, len(words)), minlength=BUCKETS))
    return len(words), (counts / max(float(np.sqrt((counts**2).sum())), 1e-9)).astype(np.float32)


#: Vectors are kept in steps of 1/_STEPS, so that their sums are exact and independent of order.
_STEPS = 2**14
_SLICE = 2000


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, _SLICE):
            hashes, sizes, found = [], [], []
            part = batch.slice(first, _SLICE)
            for h, x in zip(part.column("h").to_pylist(), part.column("text").cast(pa.binary()), strict=True):
                n, v = word_vector(x.as_py())
                if n:
                    hashes.append(h)
                    sizes.append(n)
                    found.append(np.rint(v * _STEPS).astype("<i2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], ["h", "n", "v"])


def vectors(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Each different text with words, once and staged: hash, number of words and vector in steps."""
    texts = docs.select(F.col("text").cast("string").alias("text"), row_hash("text").alias("h")).where("text <> ''")
    return scratch.stage(texts.mapInArrow(_vectors, "h long, n long, v binary").dropDuplicates(["h"]))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and vectors (in steps), a bounded number at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, _SLICE):
            part = batch.slice(first, _SLICE)
            x = np.frombuffer(b"".join(part.column("v").to_pylist()), "<i2").reshape(-1, BUCKETS).astype(float)
            yield part.column("h").to_numpy(zero_copy_only=False), x


def _farthest(centres: np.ndarray, seed: int):
    """A task's candidate for the next start: a draw in which a text counts by its distance from all starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: tuple[float, int, bytes] | None = None
        for hashes, x in _slices(batches):
            mixed = np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed) for h in hashes])
            far = np.clip(1 - (x @ centres.T).max(1) / _STEPS, 1e-9, None) if len(centres) else np.ones(len(x))
            place = -np.log((mixed + 1.0) / 2.0**64) / far
            i = int(np.lexsort((hashes, place))[0])
            now = (float(place[i]), int(hashes[i]), x[i].astype("<i2").tobytes())
            best = now if best is None or now < best else best
        rows = [best] if best else []
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.float64(), pa.int64(), pa.binary()))], ["place", "h", "v"])

    return run


def _sums_per_centre(centres: np.ndarray):
    """A task's vectors summed per nearest centre: as many rows as centres."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), BUCKETS), np.int64)
        for _, x in _slices(batches):
            own = (x @ centres.T).argmax(1)
            total += np.rint(np.eye(len(centres))[own].T @ x).astype(np.int64)
        held = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([total[k].tobytes() for k in held], pa.binary())], ["k", "v"])

    return run


def _combined(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(v, np.int64) for v in pdf["v"])
    return pd.DataFrame({"k": [pdf["k"].iloc[0]], "v": [total.tobytes()]})


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def fit_topics(docs: DataFrame, topics: int = 8, rounds: int = 15, seed: int = 17, staged: DataFrame | None = None) -> np.ndarray:
    """Topic centres by spherical k-means over all documents, each different text once.

    ``staged`` gives their :func:`vectors` where the caller has them. Starts are drawn one after another by distance from those before, with hashes of
    the texts as the dice. Each round is one aggregation: sums per centre in every task, then combined. Sums
    are exact, so the centres depend on the rows alone. Only ``topics`` vectors a round reach the driver.
    """
    scratch = Scratch(docs.sparkSession, "topics")
    rows = vectors(docs, scratch) if staged is None else staged
    c = np.zeros((0, BUCKETS))
    for k in range(topics):
        found = rows.mapInArrow(_farthest(c, seed + k), "place double, h long, v binary").orderBy("place", "h").limit(1).collect()
        if not found:
            break
        c = np.concatenate([c, _unit(np.frombuffer(found[0].v, "<i2").astype(float))[None]])
    for _ in range(rounds if len(c) else 0):
        sums = rows.mapInArrow(_sums_per_centre(c), "k int, v binary").groupBy("k").applyInPandas(_combined, "k int, v binary").collect()
        used, c = c, c.copy()
        for r in sums:
            c[r.k] = _unit(np.frombuffer(r.v, np.int64).astype(float))
        if np.array_equal(used, c):
            break
    if staged is None:
        scratch.release(rows)
    return c.astype(np.float32) if len(c) else np.zeros((1, BUCKETS), np.float32)


def _topics(centres: np.ndarray):
    """The nearest centre of each vector, as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _SLICE):
                part = batch.slice(first, _SLICE)
                for hashes, x in _slices(iter([part])):
                    nearest = (x @ centres.T).argmax(1)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array([str(k) for k in nearest.tolist()], pa.string()), part.column("n")], ["h", "topic", "n_tokens"])

    return run


def _damped(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """The default target of a margin: shares of tokens raised to ``power``, which lifts the rare values."""
    own = cells.groupBy(margin).agg(F.pow(F.sum("n_tokens").cast("double"), power).alias("share"))
    return own.withColumnRenamed(margin, "value")


def rake(cells: DataFrame, targets: dict[str, DataFrame], scratch: Scratch, sweeps: int = 24, tolerance: float = 1e-2) -> tuple[DataFrame, float]:
    """``cells(source, lang, topic, n_tokens)`` with ``ratio``, raked until all margins hold their targets.

    ``targets`` has rows (value, share) per margin; shares count relative to each other over the values that
    hold tokens, and a value not named gets none. Each sweep scales every margin in turn: a sum per value,
    combined before the shuffle and joined back; each sweep is staged, so plans stay small. Returns the cells and the
    largest relative error left; one number per third sweep reaches the driver.
    """
    total = float(cells.agg(F.sum("n_tokens")).first()[0] or 0)
    now = cells.withColumn("ratio", F.lit(1.0))
    for m in MARGINS:
        held = cells.groupBy(m).agg(F.sum("n_tokens").alias("t")).where("t > 0").select(F.col(m).alias("value"))
        goal = held.join(targets[m], "value", "left").select(F.col("value").alias(m), F.coalesce("share", F.lit(0.0)).alias("share"))
        share = float(goal.agg(F.sum("share")).first()[0] or 0)
        now = now.join(goal.select(m, (F.col("share") * (total / share if share else 0.0)).alias(f"{m}_goal")), m, "left")
    now = scratch.stage(now)
    weight, error = F.sum(F.col("ratio") * F.col("n_tokens")).alias("have"), float("inf")
    for sweep in range(sweeps):
        used = now
        for m in MARGINS:
            scaled = F.when(F.col("have") > 0, F.col("ratio") * F.coalesce(f"{m}_goal", F.lit(0.0)) / F.col("have")).otherwise(F.col("ratio"))
            now = now.join(now.groupBy(m).agg(weight), m).withColumn("ratio", scaled).drop("have")
        now = scratch.stage(now)
        scratch.release(used)
        if sweep % 3 != 2:  # looked at every third sweep; the last margin holds exactly
            continue
        off = [now.groupBy(m).agg(weight, F.max(f"{m}_goal").alias("goal")).where("goal > 0").select(F.abs(F.col("have") / F.col("goal") - 1).alias("e")) for m in MARGINS[:-1]]
        error = float(off[0].unionByName(off[1]).agg(F.max("e")).first()[0] or 0)
        if error <= tolerance:
            break
    return now.select(*cells.columns, "ratio"), error


def _scale(raked: DataFrame, budget: float) -> float:
    """The factor at which ``least(1, factor * ratio)`` draws ``budget`` of the tokens.

    Solved on tokens per 1/64 octave of ratio: a few thousand rows at most, whatever the cells.
    """
    octave = F.floor(F.log2("ratio") * 64).cast("int")
    rows = raked.where("ratio > 0 and n_tokens > 0").groupBy(octave.alias("o")).agg(F.sum("n_tokens").alias("t")).collect()
    if not rows:
        return 1.0
    ratio, tokens = np.exp2((np.array([r.o for r in rows]) + 0.5) / 64), np.array([r.t for r in rows], float)
    low, high = 0.0, 1 / ratio.min()
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (tokens * np.minimum(1, mid * ratio)).sum() < budget * tokens.sum() else (low, mid)
    return float(high)


def calibrated(docs: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = 0.7, topics: int = 8, budget: float = 0.5, seed: int = 17) -> DataFrame:
    """Every document with its raked weight, sampling probability and whether it is drawn.

    Token weights (words) are raked to the source, language and topic margins; without ``targets`` these are
    the shares of tokens raised to ``power``. The probability of a document is its cell's ratio of raked to
    present tokens times one factor, at most 1, with the factor chosen so that about ``budget`` of all tokens
    are expected: the sample holds the three margins but for cells that are taken whole. The draw is a
    seeded hash of the row against it. Rows: doc_id, source, lang,
    topic, n_tokens, weight, probability, kept, row_hash, margin_error (the largest relative error of a raked
    margin, over 0.01 where cells contradict their targets).

    Each different text is made a vector once; its topic comes back to its copies by hash, in a join of narrow staged
    rows, so a hot text's rows can be split.

    NULL sources and languages are values of their own. Empty and NULL texts have no topic and no tokens and
    take their margins' ratio. Repeated rows are drawn alike; a text as near to two centres has the first. Very long texts
    are counted whole. Other columns, whatever their names, are not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    marked = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(_NONE)).alias(c)
    found = vectors(docs, scratch)
    topic_of = scratch.stage(found.mapInArrow(_topics(fit_topics(docs, topics, seed=seed, staged=found)), "h long, topic string, n_tokens long"))
    scratch.release(found)
    # Hashes are of the columns as they are; NULL is marked only beside them.
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash("doc_id", "text", "source", "lang").alias("row_hash"), row_hash("text").alias("h"), marked("source"), marked("lang"))
    narrow = scratch.stage(hashed)
    topic, n = F.coalesce("topic", F.lit(_NONE)).alias("topic"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens")
    rows = scratch.stage(narrow.join(topic_of, "h", "left").select("doc_id", "row_hash", "source", "lang", topic, n))
    scratch.release(narrow, topic_of)
    cells = scratch.stage(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("n_tokens")))
    targets = targets or {m: _damped(cells, m, power) for m in MARGINS}
    raked, error = rake(cells, targets, scratch)
    raked = scratch.stage(raked)
    scale = _scale(raked, budget)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "row_hash"), 11) / F.lit(2.0**53)
    probability = F.least(F.lit(1.0), F.col("ratio") * scale)
    plain = [F.when(F.col(m) != _NONE, F.col(m)).alias(m) for m in MARGINS]
    out = rows.join(raked.drop("n_tokens"), list(MARGINS))
    return out.select("doc_id", *plain, "n_tokens", F.col("ratio").alias("weight"), probability.alias("probability"), (draw < probability).alias("kept"), "row_hash", F.lit(error).alias("margin_error"))


def sample_mixture(docs: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``; all columns stay as they are."""
    decided = calibrated(docs, **options).select(F.col("doc_id").alias("__id"), F.col("row_hash").alias("__hash"), "kept")
    return kept_only(docs, decided, row_hash("doc_id", "text", "source", "lang"), Scratch(docs.sparkSession, "mixture_kept"))
