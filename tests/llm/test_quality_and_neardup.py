import numpy as np
import pytest

from starledger.llm import neardup, quality

SCHEMA = "doc_id long, text string, lang string, source string, distance string, kept string"
WORDS = [f"w{i}" for i in range(400)]


def frame(spark, rows):
    """Documents with extra columns whose names clash with columns of the operators."""
    return spark.createDataFrame([(*r, *(None,) * (4 - len(r)), "x", "y") for r in rows], SCHEMA)


def plain_statistics(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in again for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


@pytest.mark.parametrize("text", [None, "", " \n\t", "a b", "a b c a b c", "é ñ x y #*\n\n#*\n#*", "x y z x y z\nx y z\n x y z", "日本 語 & <b>\r\nq"])
def test_statistics_agree_with_brute_force(text):
    assert quality.text_statistics(None if text is None else text.encode())[:5] == plain_statistics(text)


def test_statistics_of_random_and_very_long_texts():
    rng = np.random.default_rng(3)
    for n in (60, 500):
        text = " ".join(rng.choice(WORDS[:12], n)) + "\n" + "\n".join(rng.choice(WORDS[:5], 20))
        assert quality.text_statistics(text.encode())[:5] == plain_statistics(text)
    long = ("ab cd\n" * 300_000).encode()
    assert quality.text_statistics(long)[0] == 600_000


def test_concentration_finds_the_planted_centre(spark):
    rng = np.random.default_rng(5)
    rows = [(f"g{k % 2}", *(rng.normal(3 * (k % 2), 1, 5) if k % 5 else rng.normal(30, 1, 5))) for k in range(2000)]
    df = spark.createDataFrame([tuple(map(lambda v: v if isinstance(v, str) else float(np.round(v * 1024) / 1024), r)) for r in rows], "g string, f0 double, f1 double, f2 double, f3 double, f4 double")
    from starledger.llm.common import Scratch

    found = {r.g: r for r in quality.estimate(df, Scratch(spark, "test")).collect()}
    for g, centre in (("g0", 0), ("g1", 3)):
        assert np.abs(np.array(found[g]["mean"]) - centre).max() < 0.2
        white = np.zeros((5, 5))
        for (i, j), v in zip(quality.PAIRS, found[g]["white"], strict=True):
            white[i, j] = v
        inner = np.array([r[1:] for r in rows if r[0] == g and r[1] < 15])
        d = (((inner - found[g]["mean"]) @ white.T) ** 2).sum(1) / found[g]["scale"]
        outer = np.array([r[1:] for r in rows if r[0] == g and r[1] > 15])
        far = (((outer - found[g]["mean"]) @ white.T) ** 2).sum(1) / found[g]["scale"]
        assert (d < quality.CHI_9999).mean() > 0.99 and (far > quality.CHI_9999).all()


def test_outliers_go_and_every_odd_row_has_a_verdict(spark):
    rng = np.random.default_rng(1)
    good = [(i, " ".join(rng.choice(WORDS, int(rng.integers(60, 300)))), "en", "s0" if i % 3 else None) for i in range(600)]
    bad = [(1000 + i, " ".join(w + "$$$" for w in rng.choice(WORDS, 100)), "en", "s0") for i in range(20)]
    odd = [(2000, None, "en", "s0"), (2001, "", None, None), (None, "few words", "xx", "s1"), good[0], good[0]]
    docs = frame(spark, [*good, *bad, *odd])
    rows = quality.quality_verdicts(docs, min_rows=100).collect()
    assert len(rows) == len(good) + len(bad) + len(odd)
    kept = {r.doc_id for r in rows if r.kept}
    assert kept == {g[0] for g in good}
    left = quality.keep_good(docs, min_rows=100)
    assert left.columns == docs.columns and left.count() == 602
    assert quality.quality_verdicts(docs.limit(0)).count() == 0


def test_documents_of_small_pools_are_judged_by_the_whole_table(spark):
    rng = np.random.default_rng(6)
    good = [(i, " ".join(rng.choice(WORDS, int(rng.integers(60, 300)))), "en", "s0") for i in range(300)]
    rare = [(500 + i, " ".join(rng.choice(WORDS, 100)), "fi", "s1") for i in range(5)]
    bad = [(600, " ".join(w + "$$$" for w in rng.choice(WORDS, 100)), "fi", "s1"), (601, "too short", "xx", None)]
    for rows in ([*good, *rare, *bad], [*good[:60], *rare, *bad]):
        got = {r.doc_id: r for r in quality.quality_verdicts(frame(spark, rows)).collect()}
        assert all(r.distance is not None for r in got.values())
        assert not got[600].kept and not got[601].kept and got[600].distance > quality.CHI_9999
        assert all(got[r[0]].kept for r in rows if r[0] < 600)


def brute_components(texts, k, percent):
    def shingles(t):
        w = (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
        return frozenset(tuple(w[i : i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)) if w else frozenset()

    sets = {i: shingles(t) for i, t in texts.items()}
    up = {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in texts}


def near_texts(n_groups=12, copies=9, seed=2):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n_groups):
        base = list(rng.choice(WORDS, int(rng.integers(3, 120))))
        for _ in range(copies):
            t = list(base)
            for _ in range(int(rng.integers(0, 6))):
                t[int(rng.integers(len(t)))] = str(rng.choice(WORDS))
            out.append(" ".join(t))
    return dict(enumerate(out + ["", None, "One", "one", "ONE two", "one two", "Ä b c", "ä b c"]))


@pytest.mark.parametrize("k, percent, options", [(3, 85, {}), (5, 80, {}), (3, 85, {"limit": 4, "depth": 4}), (3, 85, {"most_sets": 5, "block": 3, "limit": 3}), (3, 85, {"most_sets": 5, "most_members": 150, "limit": 3})])
def test_components_agree_with_brute_force(spark, k, percent, options):
    texts = near_texts()
    got = neardup.near_duplicates(frame(spark, list(texts.items())), words=k, percent=percent, **options).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, k, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_large_group_of_near_copies_in_blocks(spark):
    texts = near_texts(n_groups=2, copies=120, seed=9)
    got = neardup.near_duplicates(frame(spark, list(texts.items())), words=3, percent=85, most_sets=20, block=15, limit=8).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in brute_components(texts, 3, 85).items()}


def test_repeated_rows_nulls_and_empty_tables(spark):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (3, "A b c d e f g"), (None, "a b c d e f g"), (7, None), (8, ""), (None, None)]
    docs = frame(spark, rows)
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert got == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (-1, 3, False), (7, 7, True), (8, 8, True), (-1, -1, True)])
    left = neardup.keep_one_of_each(docs)
    assert left.columns == docs.columns and sorted((r.doc_id or -1) for r in left.collect()) == [-1, 3, 7, 8]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0 and neardup.keep_one_of_each(docs.limit(0)).count() == 0


def test_common_counts_of_many_sets():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 30)) for _ in range(25)]
    got = neardup.common_counts(sets)
    for i in range(25):
        for j in range(25):
            if i != j:
                assert got[i, j] == len(set(sets[i]) & set(sets[j]))


def test_components_of_chains_stars_and_ties(spark):
    from starledger.llm.common import Scratch, components

    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (3, 2), (2, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0
