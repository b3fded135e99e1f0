"""Hard negatives by exact integer scores, multiplied as residues modulo small primes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starledger.llm.common import Scratch

#: float32 holds every integer up to this exactly.
_EXACT = 1 << 24
#: Columns multiplied at once; sums over more are added as residues.
_DIMS = 4096
#: Scores worked on at once.
_TILE = 1 << 21
_LEAST = np.iinfo(np.int64).min
_PAIRS = "anchor_id long, positive_id long, positive_score long"
_FOUND = f"{_PAIRS}, negative_id long, negative_score long"


def _prime(p: int) -> bool:
    return p > 1 and all(p % q for q in range(2, int(p**0.5) + 1))


def primes_for(dims: int, bound: int) -> list[int]:
    """Primes whose residues multiply exactly in float32 and tell -bound..bound apart.

    The greatest ones come first; the last is the smallest that suffices, so the product stays under 4 * bound + 4.
    """
    width, need = max(1, min(dims, _DIMS)), 2 * bound + 1
    found, product, p = [], 1, 2 * int((_EXACT / width) ** 0.5) + 1
    while product <= need and p > 2:
        if _prime(p) and width * ((p - 1) // 2) ** 2 < _EXACT:
            found.append(p)
            product *= p
        p -= 1
    if product <= need:
        raise ValueError(f"no primes hold scores of {bound} over {dims} columns")
    product //= found.pop()
    return found + [next(p for p in count(3, 2) if p not in found and _prime(p) and product * p > need)]


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Residues of least size, -(p-1)/2 to (p-1)/2, as float32, for each prime."""
    out = []
    for p in primes:
        r = matrix % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def exact_scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products of the rows of two integer matrices given by their residues, exactly.

    One float32 product per prime; the mixed-radix digits of a score come one prime at a time, and the last
    step moves the upper half of the range below zero. The product of the primes must be under 2 ** 63.
    """
    total, radix = np.zeros((len(a[0]), len(b[0])), np.int64), 1
    for x, y, p in zip(a, b, primes, strict=True):
        r = np.zeros_like(total)
        for at in range(0, x.shape[1], _DIMS):
            r += (x[:, at : at + _DIMS] @ y[:, at : at + _DIMS].T).astype(np.int64)
        total += (r - total) % p * pow(radix, -1, p) % p * radix
        radix *= p
    return np.where(total > radix // 2, total - radix, total)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix; vectors shorter than ``dims`` end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    return out


def _dims(*tables: pa.Table) -> int:
    return max(int(np.diff(t["vector"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in tables)


def _bound(a: np.ndarray, b: np.ndarray) -> int:
    """No score of the two matrices is greater in size."""
    norms = [float((m.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) ** 0.5 for m in (a, b)]
    return int(norms[0] * norms[1] * 1.0001) + 1


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` greatest allowed scores per row; of ties, those of smaller columns."""
    masked = np.where(allowed, scores, _LEAST)
    if masked.shape[1] > k:
        least = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        allowed = allowed & (masked >= least[:, None])
    r, c = np.nonzero(allowed)
    order = np.lexsort((c, -scores[r, c], r))
    r, c = r[order], c[order]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    return r[place < k], c[place < k]


def _tiles(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple]:
    """Scores of a block of anchors with a block of rows, a few anchors at a time; rows are sorted by vec_id."""
    if not anchors.num_rows or not rows.num_rows:
        return
    rows, dims = rows.sort_by("vec_id"), _dims(anchors, rows)
    a, b = _matrix(anchors["vector"], dims), _matrix(rows["vector"], dims)
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    primes, step = primes_for(dims, _bound(a, b)), max(1, _TILE // len(b))
    theirs = residues(b, primes)
    for at in range(0, len(a), step):
        part = slice(at, at + step)
        yield part, exact_scores(residues(a[part], primes), theirs, primes), ids, labels


def _usable(rows: DataFrame, vec_id: str, label: str, vector: str, scale: int) -> DataFrame:
    """Rows that take part, components scaled and rounded down; one row per vec_id."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**31 / scale))
    kept = rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & finite).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("vector")
    )
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    kept = kept.where(squares < 2.0**60)
    return kept.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector")


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def hard_negatives(
    rows: DataFrame, anchors: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block_anchors: int = 8192, block_rows: int = 8192,
) -> DataFrame:
    """For each anchor and each of its best ``positives`` rows of its label, the best rows of other labels in a band.

    A score is the inner product of two vectors whose components are ``floor(scale * x)``. It is computed
    exactly: integer matrices are multiplied modulo primes in float32, as many primes as the block's norms
    need, and scores come back by Chinese remaindering. The negatives of a pair are the first ``negatives`` rows
    of another label with low * positive_score <= 100 * score <= high * positive_score; higher scores come
    first, ties by smaller vec_id. ``anchors`` is a condition on the columns vec_id and label.

    Blocks of anchors meet blocks of rows in tasks of bounded size; each returns its best few per anchor, and
    a window over these selects the first. Rows are dealt to blocks by a hash of vec_id, so no label or common
    vector makes a large one. A block is sent once per block of the other side: work grows with anchors times
    rows, which the search asks for.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Rows with a NULL id,
    label, vector or component, or one that is not finite, take no part; nor do those whose scores could leave
    64 bits (squares of the scaled components sum to 2^60 or more). Of rows with one vec_id the one with the
    smallest label and vector counts. Vectors of unequal length are compared over the components both have.
    Other columns are not read. Anchors without another row of their label, and pairs without a row in the band, give no rows; so
    does an empty table.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "negatives")
    usable = scratch.stage(_usable(rows, vec_id, label, vector, scale))
    chosen = scratch.stage(usable.where(anchors))
    parts_r, parts_a = _blocks(usable.count(), block_rows), _blocks(chosen.count(), block_anchors)
    deal = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    other = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    right = usable.select("vec_id", "label", "vector", deal(parts_r).alias("r"), other(parts_a).alias("a")).groupBy("a", "r")

    def near(a: pa.Table, b: pa.Table) -> pa.Table:
        # Only rows of an anchor's own label are multiplied with it.
        out = [pa.table({"anchor_id": pa.array([], pa.int64()), "positive_id": pa.array([], pa.int64()), "positive_score": pa.array([], pa.int64())})]
        mine, theirs = a["label"].to_numpy(), b["label"].to_numpy()
        for value in np.unique(mine):
            some = a.filter(pa.array(mine == value))
            for part, scores, ids, _ in _tiles(some, b.filter(pa.array(theirs == value))):
                own = some["vec_id"].to_numpy()[part]
                r, c = _best(scores, ids[None, :] != own[:, None], positives)
                out.append(pa.table({"anchor_id": own[r], "positive_id": ids[c], "positive_score": scores[r, c]}))
        return pa.concat_tables(out)

    left = chosen.select("vec_id", "label", "vector", deal(parts_a).alias("a"), other(parts_r).alias("r"))
    found = left.groupBy("a", "r").cogroup(right).applyInArrow(near, _PAIRS)
    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    pairs = found.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= positives)
    listed = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("pairs"))
    listed = scratch.stage(chosen.join(listed, "vec_id"))

    def band(a: pa.Table, b: pa.Table) -> pa.Table:
        out = [pa.table({name: pa.array([], pa.int64()) for name in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")})]
        given, mine = a["pairs"].to_pylist(), a["label"].to_numpy()
        for part, scores, ids, theirs in _tiles(a, b):
            own, pairs_, others = a["vec_id"].to_numpy()[part], given[part], theirs[None, :] != mine[part][:, None]
            for j in count():
                has = np.array([i for i, p in enumerate(pairs_) if len(p) > j], np.int64)
                if not len(has):
                    break
                p = [pairs_[i][j] for i in has]
                least, most = (np.array(x, np.int64)[:, None] for x in zip(*[(-(-low * q["positive_score"] // 100), high * q["positive_score"] // 100) for q in p], strict=True))
                mine_ = scores[has]
                r, c = _best(mine_, others[has] & (mine_ >= least) & (mine_ <= most), negatives)
                ids_, points = np.array([q["positive_id"] for q in p], np.int64), np.array([q["positive_score"] for q in p], np.int64)
                out.append(pa.table({"anchor_id": own[has][r], "positive_id": ids_[r], "positive_score": points[r], "negative_id": ids[c], "negative_score": mine_[r, c]}))
        return pa.concat_tables(out)

    left = listed.select("vec_id", "label", "vector", "pairs", deal(parts_a).alias("a"), other(parts_r).alias("r"))
    found = left.groupBy("a", "r").cogroup(right).applyInArrow(band, _FOUND)
    ranks = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
