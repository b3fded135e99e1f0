import collections

import numpy as np
from test_other_operators import brute_windows
from test_quality_and_neardup import brute_components, plain_statistics

import corpus_pipeline
from starledger.llm import mixing, quality
from starledger.session import scratch_path

RNG = np.random.default_rng(21)
WORDS = [f"w{i}" for i in range(900)]


def documents():
    items = {i: " ".join(RNG.choice(WORDS, 30)) for i in range(4)}
    texts = [" ".join(RNG.choice(WORDS, int(n))) for n in RNG.integers(60, 140, 90)]
    near = [t.rsplit(" ", 1)[0] + " changed" for t in texts[:12]] + texts[12:20]
    leaks = [f"{t} {items[i % 4]} {t[:40]}" for i, t in enumerate(texts[20:28])]
    junk = ["", None, "too short", "a b c " * 60, " \n\t"]
    rows = [(i, t, ("en", "de", None)[i % 3], ("web", "books")[i % 7 == 0], len(t or "")) for i, t in enumerate(texts + near + leaks + junk)]
    return rows + rows[:2], items


def test_each_stage_does_its_whole_work_on_what_the_last_one_kept(spark):
    rows, items = documents()
    folder = scratch_path(spark, "test-pipeline")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        assert k == 4 or out.columns == docs.columns
        path = scratch_path(spark, "test-stage")
        out.write.parquet(path)
        docs, before = spark.read.parquet(path), docs
        kept.append((before, docs))
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    # Quality: every document that the base rules pass and the estimate does not reject, and no other.
    good = {r.doc_id for r in quality.quality_verdicts(kept[0][0]).collect() if r.kept}
    assert set(texts(kept[0][1])) == good and len(good) > 90
    for t in texts(kept[0][1]).values():
        n, _, _, _, repeated = plain_statistics(t)
        assert n >= 50 and 100 * repeated <= 50 * n
    # Near duplicates: one of each group by brute force.
    given = texts(kept[1][0])
    assert set(texts(kept[1][1])) == {i for i, (_, c) in brute_components(given, 5, 80).items() if i == c} and len(given) - kept[1][1].count() >= 15
    # Decontamination: every document with a window of an item, by brute force.
    given = texts(kept[2][0])
    assert set(given) - set(texts(kept[2][1])) == {d for d, _ in brute_windows(given, items)} != set()
    # Mixing: the draw of the operator, a part of its input.
    drawn = {r.doc_id for r in mixing.calibrated(kept[3][0]).collect() if r.kept}
    assert set(texts(kept[3][1])) == drawn and 0 < len(drawn) < kept[3][0].count()
    # Sharding: all rows, counts at most one apart, gapless slots.
    shards = collections.defaultdict(list)
    for r in kept[4][1].collect():
        shards[r.shard].append(r.slot)
    assert sum(map(len, shards.values())) == kept[4][0].count()
    sizes = [len(shards[s]) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in shards.values())
    # The whole run gives the rows of its last stage.
    key = lambda df: sorted((r.doc_id, r.text_crc32, r.shard, r.slot) for r in df.collect())
    assert key(corpus_pipeline.run(spark, folder)) == key(kept[4][1])
