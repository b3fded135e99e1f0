import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starledger.llm.exact_dedup import exact_duplicates
from starledger.llm.hard_negatives import exact_scores, hard_negatives, primes_for, residues
from starledger.llm.infill import BLANK, LINE_FEED, STOP, WaveletMatrix, fill_in_middle, restored

RNG = np.random.default_rng(11)

# --- hard negatives ------------------------------------------------------------------------------------------


def test_residue_products_are_exact_at_every_size():
    for dims, size in ((0, 5), (1, 2**29), (3, 7), (64, 300), (64, 2**26), (5000, 90), (4097, 2**20)):
        a, b = (RNG.integers(-size, size + 1, (n, dims)) for n in (5, 9))
        bound = int(max((a.astype(object) ** 2).sum(axis=1).max(initial=0), (b.astype(object) ** 2).sum(axis=1).max(initial=0)))
        primes = primes_for(dims, bound)
        assert 2 * bound + 1 < np.prod([float(p) for p in primes]) < 2**63 and len(set(primes)) == len(primes)
        assert all(min(dims, 4096) * ((p - 1) // 2) ** 2 < 2**24 for p in primes)
        got = exact_scores(residues(a, primes), residues(b, primes), primes)
        assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()


def brute_negatives(rows, is_anchor, positives=5, negatives=3):
    best = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (label, [int(np.floor(256 * float(x))) for x in v])
        best[i] = min(best.get(i, row), row)
    out, score = set(), lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, (label, v) in best.items():
        if not is_anchor(i):
            continue
        scores = {j: score(v, w) for j, (_, w) in best.items() if j != i}
        first = lambda ids, n: sorted(ids, key=lambda j: (-scores[j], j))[:n]
        for p in first([j for j in scores if best[j][0] == label], positives):
            band = [j for j in scores if best[j][0] != label and 50 * scores[p] <= 100 * scores[j] <= 95 * scores[p]]
            out |= {(i, p, r + 1, j, scores[p], scores[j]) for r, j in enumerate(first(band, negatives))}
    return out


def vectors(n=260):
    base = RNG.normal(size=(12, 6))
    rows = [(i, int(RNG.integers(0, 3)), (base[RNG.integers(0, 12)] + RNG.integers(0, 3) * 0.25).tolist()) for i in range(n)]
    rows += [(n + i, 1, [0.5] * 6) for i in range(90)]  # one common vector: ties
    rows += [(n + 100, 2, [3e5] * 6), (n + 102, 1, [3e5, 2e5, 3e5, 1.0, 0.0, -4.0])]
    odd = [(None, 1, [1.0] * 6), (400, None, [1.0] * 6), (402, 1, None), (404, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (406, 1, [float("nan")] * 6), (408, 0, [float("inf")] * 6), (410, 2, []), (412, 2, [1.0, 2.0])]
    return rows + odd + rows[:40] + [(4, 0, [9.0] * 6), (4, 0, [-9.0] * 6)]


@pytest.mark.parametrize("blocks", [(8192, 8192), (7, 50)])
def test_negatives_agree_with_brute_force(spark, blocks):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, label int, embedding array<double>, rank string, anchor_id int")
    for data, want in ((df, brute_negatives(rows, lambda i: i % 10 == 0)), (df.limit(0), set())):
        got = [tuple(r) for r in hard_negatives(data, F.col("vec_id") % 10 == 0, block_anchors=blocks[0], block_rows=blocks[1]).collect()]
        assert set(got) == want and len(got) == len(want)
    assert hard_negatives(df, F.lit(False)).count() == 0


# --- exact duplicates ----------------------------------------------------------------------------------------


def test_refinement_agrees_with_grouping_whole_texts(spark):
    stem = "the same long beginning " * 9
    texts = [None, "", " ", "\t\n", "a", " a", "a b", "a\tb", "a  b\n", "é b", "é b", stem + "x", stem + "y", stem + "x", "w " * 40000, "w\n" * 40000, "w " * 39999 + "v"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, "one very common text") for i in range(200)]
    rows += [(3, "repeat"), (3, "repeat"), (None, "repeat"), (None, "none only"), (None, "none only"), (7, None)]
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], "doc_id long, text string, keep_id string, t string, n int")
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    for prefix, buckets, every in ((64, 1024, False), (2, 1, True), (1, 3, False)):
        got = exact_duplicates(df, prefix, buckets, every).collect()
        want = sorted((str(i), str(min((x for x in ids if x is not None), default=None)), len(ids), len(t)) for t, ids in groups.items() for i in ids)
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.n_chars) for r in got) == want
        assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
        digests = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
        assert all(r.group_size == len(digests[r.digest]) for r in got if r.digest is not None)
        assert all((r.digest is None) == (r.level < 3 and not every) for r in got)
    # A length of its own ends the search at once, a beginning of its own at level 2.
    levels = {r.doc_id: r.level for r in exact_duplicates(df).collect() if r.doc_id is not None}
    assert (levels[16], levels[4], levels[11], levels[12], levels[14]) == (1, 2, 3, 3, 3)
    assert exact_duplicates(df.limit(0)).count() == 0


def test_refinement_reads_texts_in_place_and_stays_native(spark):
    df = exact_duplicates(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert {(r.doc_id, r.keep_id, r.kept) for r in df.collect()} == {(1, 1, True), (2, 1, False), (3, 3, True)}


# --- fill in the middle --------------------------------------------------------------------------------------


def test_ranks_and_bisection_agree_with_counting():
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = RNG.integers(0, 4, n).astype(np.uint8)
        m, at = WaveletMatrix(symbols, 2), np.arange(n + 1)
        for s in range(4):
            assert (m.rank(s, at) == np.concatenate([[0], np.cumsum(symbols == s)])).all()
        for wanted in ((LINE_FEED,), (LINE_FEED, BLANK), (LINE_FEED, STOP)):
            ends = np.flatnonzero(np.isin(symbols, wanted)) + 1
            k = np.arange(len(ends) + 2)
            got = m.bisect(wanted, np.zeros_like(k), np.full_like(k, n), k)
            assert got.tolist() == [0, *ends.tolist(), n]


PATTERNS = {"line": "[^\n]*\n|[^\n]+", "sentence": "[^\n.!?]*[\n.!?]|[^\n.!?]+", "word": "[^\n\t\x0b\x0c\r ]*[\n\t\x0b\x0c\r ]|[^\n\t\x0b\x0c\r ]+"}


def brute_infill(doc_id, text, unit, percent, spm):
    text, h = text or "", hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = re.findall(PATTERNS[unit], text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= percent:
        return (doc_id, n, "plain", None, None, text)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if h4 % 100 < spm:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("unit,percent,spm", [("line", 100, 50), ("sentence", 60, 0), ("word", 100, 100)])
def test_infill_agrees_with_cutting_by_pattern(spark, monkeypatch, unit, percent, spm):
    alphabet = list("ab.\n\n é𝄞\t<>PSM\x00 ")
    texts = ["".join(RNG.choice(alphabet, int(n))) for n in RNG.integers(0, 60, 150)]
    texts += [None, "", "\n", "\n\n", "a", "x<P>y", "<S", "<M", "a\n<S\nb\n<\nP>\n", "line of text\n" * 20000, "no end " * 30000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a\nb\nc"), (5, "a\nb"), (5, "a\nb"), (-3, "k\n" * 9)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, h1 int, form string").repartition(3)
    got = fill_in_middle(df, unit, percent=percent, spm_percent=spm).withColumn("back", restored()).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted([brute_infill(i, t, unit, percent, spm) for i, t in rows], key=key)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    assert fill_in_middle(df.limit(0)).count() == 0
