import collections
import hashlib
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest

from starledger.llm import decontaminate, html_consensus, language, log_templates, mixing, sharding, tokens
from starledger.llm.common import Scratch
from starledger.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, shard string, n_tokens string"
WORDS = [f"w{i}" for i in range(300)]
ODD = ["", None, " ", "a", "  two  spaces   three\n\n x\t y ", "<|endoftext|> x<|endoftext|>y", "é́ ß Σας", "a b c　d\u0085e\x1cf", "it's 12,345 ok!? ... \r\n"]
RNG = np.random.default_rng(4)
TEXTS = ODD + [" ".join(RNG.choice(WORDS, int(n))) for n in RNG.integers(1, 200, 40)]


def frame(spark, texts=None, ids=None):
    texts = TEXTS if texts is None else texts
    rows = [(i if ids is None else ids[i], t, ("en", "de", None)[i % 3], ("s0", "s1", None, "s0")[i % 4], "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# --- tokens ------------------------------------------------------------------------------------------------


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def test_counts_come_from_the_tokenizer_and_the_cache_grows_by_misses_only(spark):
    path, cache = public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "test-cache")
    t = tokenizer("word_bpe_49k.json")
    docs = frame(spark, TEXTS + TEXTS[:5])
    for _ in range(2):
        rows = tokens.count_tokens(docs, path, limit=100, cache=cache).collect()
        want = collections.Counter((i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in enumerate(TEXTS + TEXTS[:5]))
        assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
        assert all(r.over_limit == (r.n_tokens > 100) for r in rows)
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("digest").distinct().count() == len({re.sub("[ \t\n\x0b\f\r]+", " ", x or "").strip(" ") for x in TEXTS})
    assert tokens.count_tokens(docs.limit(0), path).count() == 0


def test_ids_do_not_depend_on_what_was_encoded_before():
    """One encoder for all texts, odd white space of all kinds first: 20,000 random texts, then the odd ones again."""
    encoder, t = tokens._Ids(public_tokenizers.path("byte_bpe_50k.json")), tokenizer("byte_bpe_50k.json")
    rng = np.random.default_rng(7)
    parts = ["word", "a", "1", ".", ",", "\n", " ", "  ", "\t", "\u00a0", "\u2028", "\x1c", "\r\n", "é", "<|endoftext|>", "<|", "字", "'s", "\u00ad", "\u3000"]
    texts = [x for x in ODD if x] + parts + ["word\n\u00a0", "\u00a0", "x \u00a0", "\u00a0\n", ".\n,"]
    texts += ["".join(rng.choice(parts, int(n))) for n in rng.integers(1, 9, 20_000)]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500] + texts[:40]
        want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(some, add_special_tokens=False)]
        assert encoder.encode(some) == want


@pytest.mark.parametrize("plane", ["byte", "bit"])
def test_planes_round_trip(plane):
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 64, 1000, 4097):
        ids = rng.integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
        sizes, payload = tokens.pack(ids, 512, plane)
        assert (tokens.unpack(n, sizes, payload, 512, plane) == ids).all()


def test_pieces_have_the_ids_of_the_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, own = tokenizer("byte_bpe_50k.json"), tokens._Ids(path)
    texts = [x or "" for x in TEXTS] + [" a", "a ", "  ", "\n a \n\n b  \t c", "a  b   c", "x  y", "it's, we'll.\nDon't 3.5, 4. ,, a.b,\n\nend.", "\n", "a\n", "\na", "a\u2003 b", "x, y.\n z"]
    got = [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in texts]
    for x in texts:
        assert "".join(tokens.pieces(x)) == x


@pytest.mark.parametrize("plane, chunk", [("byte", 50), ("bit", 10**6)])
def test_id_files_hold_every_document_in_order(spark, plane, chunk):
    t, folder = tokenizer("byte_bpe_50k.json"), scratch_path(spark, "test-ids")
    tokens.write_ids(frame(spark), public_tokenizers.path("byte_bpe_50k.json"), folder, block=64, chunk_ids=chunk, plane=plane)
    rows = {r.doc_id: tuple(r[1:]) for r in tokens.read_ids(spark, folder, block=64, plane=plane).collect()}
    start, want = 0, {}
    for i, x in enumerate(TEXTS):
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert rows == want


def test_id_files_of_repeated_ids_and_of_nothing(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = scratch_path(spark, "test-ids")
    tokens.write_ids(frame(spark, ["b", "a", "a", None], [3, 3, 3, None]), path, folder)
    rows = sorted(tokens.read_ids(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 3, 3, 3] and [r.start for r in rows] == [0, 1, 3, 5]
    folder = scratch_path(spark, "test-ids")
    tokens.write_ids(frame(spark).limit(0), path, folder)
    assert tokens.read_ids(spark, folder).count() == 0


# --- sharding ----------------------------------------------------------------------------------------------


def test_shards_follow_fractional_ranks(spark):
    docs = frame(spark)
    by = collections.defaultdict(list)
    for i, x in enumerate(TEXTS):
        s = ("s0", "s1", None, "s0")[i % 4]
        by[s].append((hashlib.md5(f"shards:{i}".encode()).hexdigest(), i, x or ""))
    order = sorted(((2 * k + 1) / (2 * len(v)), m, i, x) for v in by.values() for k, (m, i, x) in enumerate(sorted(v)))
    want, slots = {}, collections.Counter()
    for p, (_, _, i, x) in enumerate(order):
        shard = p * 5 // len(order)
        want[i] = (len(x.encode()) + 8, zlib.crc32(x.encode()), "rows", shard, slots[shard], None)
        slots[shard] += 1
    rows = sharding.interleave(docs, shards=5).collect()
    assert {r.doc_id: tuple(r[1:7]) for r in rows} == want
    assert max(slots.values()) - min(slots.values()) <= 1


def test_shards_of_repeated_rows_and_of_nothing(spark):
    rows = sharding.interleave(frame(spark, ["a"] * 10, [1] * 8 + [None] * 2), shards=3).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s, n in enumerate((4, 3, 3)) for k in range(n)]
    few = sharding.interleave(frame(spark, ["a", "b"]), shards=24).collect()
    assert len(few) == 2 and {r.slot for r in few} == {0}
    assert sharding.interleave(frame(spark).limit(0)).count() == 0


# --- mixing ------------------------------------------------------------------------------------------------


def test_raked_margins_hold_their_targets(spark):
    cells = [(s, m, t, int(RNG.integers(1, 1000))) for s in ("a", "b", "\x00") for m in ("x", "y") for t in ("0", "1")]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, n_tokens long")
    shares = {"source": [("a", 2.0), ("b", 1.0), ("\x00", 1.0), ("absent", 5.0)], "lang": [("x", 0.3), ("y", 0.7)], "topic": [("0", 0.5), ("1", 0.5)]}
    targets = {m: spark.createDataFrame(v, "value string, share double") for m, v in shares.items()}
    raked, error = mixing.rake(df, targets, Scratch(spark, "test"), tolerance=1e-6)
    rows = raked.collect()
    total = sum(c[3] for c in cells)
    assert error < 1e-6
    for m, want in {"source": {"a": 0.5, "b": 0.25, "\x00": 0.25}, "lang": {"x": 0.3, "y": 0.7}, "topic": {"0": 0.5, "1": 0.5}}.items():
        for value, share in want.items():
            assert sum(r.ratio * r.n_tokens for r in rows if r[m] == value) / total == pytest.approx(share, rel=1e-4)
    w = {c[:3]: float(c[3]) for c in cells}  # brute force
    for _ in range(200):
        for i, want in enumerate(({"a": 0.5, "b": 0.25, "\x00": 0.25}, {"x": 0.3, "y": 0.7}, {"0": 0.5, "1": 0.5})):
            have = collections.Counter()
            for k, v in w.items():
                have[k[i]] += v
            w = {k: v * want[k[i]] * total / have[k[i]] for k, v in w.items()}
    for r in rows:
        assert r.ratio * r.n_tokens == pytest.approx(w[r.source, r.lang, r.topic], rel=1e-3)


def test_topics_are_fitted_on_all_documents_and_copies_count_once(spark):
    rng = np.random.default_rng(3)
    names = [[f"{t}word{i}" for i in range(30)] for t in "abc"]
    common = [" ".join(rng.choice(names[0], 40)) for _ in range(2500)]
    rare = [" ".join(rng.choice(names[t], 40)) for t in (1, 2) for _ in range(3)]
    texts = [*common, *[common[0]] * 1500, *rare, "", None]
    rows = [(i, t, "en", "s", "x", "y") for i, t in enumerate(texts)]
    found = [mixing.fit_topics(spark.createDataFrame(r, SCHEMA).repartition(n), topics=3) for r, n in ((rows, 3), (rows[:2500] + rows[4000:][::-1], 7))]
    assert (found[0] == found[1]).all()
    own = [int((found[0] @ mixing.word_vector((t or "").encode())[1]).argmax()) for t in (common[0], rare[0], rare[3])]
    assert len(set(own)) == 3


def test_draws_follow_probabilities_and_keep_columns(spark):
    docs = frame(spark, TEXTS * 10)
    rows = mixing.calibrated(docs, topics=3).collect()
    assert len(rows) == len(TEXTS) * 10 and all(0 <= r.probability <= 1 for r in rows)
    tokens_all = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.probability for r in rows) == pytest.approx(0.5 * tokens_all, rel=0.03)
    assert sum(r.n_tokens for r in rows if r.kept) == pytest.approx(0.5 * tokens_all, rel=0.3)
    drawn = mixing.sample_mixture(docs, topics=3)
    assert drawn.columns == docs.columns and drawn.count() == sum(r.kept for r in rows)
    assert mixing.calibrated(docs.limit(0)).count() == 0
    assert mixing.calibrated(frame(spark, ["", None])).count() == 2


# --- decontamination ---------------------------------------------------------------------------------------


def brute_windows(texts, items, k=5, percent=80):
    import regex

    def words(t):
        return [w for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w]

    def bag(w, k):
        return collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

    out = {}
    for d, t in texts.items():
        w = words(t)
        for i, x in items.items():
            own = words(x)
            if not own:
                continue
            a, best = bag(own, min(k, len(own))), (0, 0)
            for s in range(max(1, len(w))):
                b = bag(w[s : s + len(own)], min(k, len(own)))
                if b and 100 * sum((a & b).values()) >= percent * sum((a | b).values()):
                    best = max(best, (sum((a & b).values()) / sum((a | b).values()), -s))
            if best[0]:
                out[d, i] = (pytest.approx(best[0]), -best[1])
    return out


def test_windows_agree_with_brute_force(spark):
    rng = np.random.default_rng(8)
    items = {i: " ".join(rng.choice(WORDS, int(n))) for i, n in enumerate(rng.integers(1, 60, 25))} | {90: "", 91: None, 92: "w1 w1 w1 w1 w1 w1 w1 w1"}
    texts = {}
    for d in range(80):
        base = list(rng.choice(WORDS, int(rng.integers(0, 80))))
        if d % 2:
            own = list((items[d % 25]).split(" "))
            for _ in range(d % 5):
                own[int(rng.integers(len(own)))] = str(rng.choice(WORDS)).upper()
            base[len(base) // 2 : len(base) // 2] = own
        texts[d] = ", ".join(base) if d % 3 else " ".join(base)
    texts |= {200: None, 201: "", 202: "w1 " * 30}
    docs = spark.createDataFrame([(d, t, "x", "z") for d, t in texts.items()], "doc_id long, text string, item_id string, start string")
    bench = spark.createDataFrame([(i, t, "q") for i, t in items.items()], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontaminate.contaminated_windows(docs, bench).collect()}
    assert got == brute_windows(texts, items) and len(got) > 10
    left = decontaminate.without_benchmark(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(texts) - {d for d, _ in got}
    assert decontaminate.contaminated_windows(docs.limit(0), bench).count() == decontaminate.contaminated_windows(docs, bench.limit(0)).count() == 0


def test_items_cut_off_at_the_end_of_a_text_are_found(spark):
    item = " ".join(f"q{i}" for i in range(50))
    cut = " ".join(item.split(" ")[:42])
    texts = {1: cut, 2: f"before it {cut}", 3: " ".join(item.split(" ")[:40]), 4: f"{cut} and other words follow here now then so"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontaminate.contaminated_windows(docs, bench).collect()}
    assert got == brute_windows(texts, {7: item}) and set(got) == {(1, 7), (2, 7)}


def test_every_fingerprint_within_the_radius_shares_a_block():
    rng = np.random.default_rng(1)
    masks = set(decontaminate._MASKS)
    for _ in range(300):
        flips = rng.choice(64, decontaminate.RADIUS, replace=False)
        x = sum(1 << int(f) for f in flips)
        assert any((x >> (8 * i)) & 255 in masks for i in range(8))


# --- html --------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body class="has-sidebar">
<header>H</header><nav><a href=/>Home</a></nav><div class="wrap"><div class="sidebar"><p>side %s</p></div><div class="post-content p-%d">
<h1>Title &amp; more</h1><p>First   text<br>goes <b>on<p>Second &lt;b&gt; %s<ul><li>one<li>two</ul>
<div class="advert">Buy</div><form><input>F</form><section id="comments"><p>nice</p></section></div></div><footer>&copy;</footer></body></html>"""


def test_articles_and_odd_pages(spark):
    filler = "long text of this page " * 5
    rows = [(i, f"http://h.example.org/{i}", PAGE % ("x", i, filler)) for i in range(8)]
    odd = [(20, None, None), (21, "no url", ""), (22, "http://h.example.org/", "plain text"), (23, "http://x.org", "<p>a<p>b"), (24, "http://x.org", "<a href='"), (25, "http://x.org", "<nav>only</nav>")]
    pages = spark.createDataFrame([(*r, "t", "h") for r in [*rows, *odd, rows[0]]], "page_id long, url string, html string, text string, host string")
    got = collections.defaultdict(list)
    for r in html_consensus.main_texts(pages).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    want = "Title & more\n\nFirst text goes on\n\nSecond <b> " + filler.strip() + "\n\none\n\ntwo"
    assert got[0] == [want, want] and all(got[i] == [want] for i in range(1, 8))
    assert [got[i][0] for i in (20, 21, 22, 23, 25)] == ["", "", "plain text", "a\n\nb", ""]
    assert html_consensus.main_texts(pages.limit(0)).count() == 0


def test_the_host_outvotes_a_page_with_more_text_elsewhere(spark):
    normal = "<body><div class='main'><p>%s</p></div><div class='box'><p>short</p></div></body>"
    odd = "<body><div class='main'><p>%s</p></div><div class='box'><p>%s</p></div></body>" % ("story " * 20, "extra " * 25)
    rows = [(i, "http://a.org/", normal % ("story " * 20)) for i in range(6)] + [(9, "http://a.org/", odd)]
    got = {r.page_id: r.text for r in html_consensus.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == ("story " * 20).strip()


def test_every_layout_of_a_host_votes_and_classes_of_one_page_do_not_part_them(spark):
    page = "<body class='%s'><div class='main%s'><p>%s</p></div><div class='box%s'><p>%s</p></div></body>"
    letters, story = "abcdefghijkl", ("story " * 20).strip()
    rows = [(100 * k + i, "http://a.org/", page % ("", f"-{x}", story, f"-{x}", "short")) for k, x in enumerate(letters) for i in range(6)]
    rows += [(100 * k + 9, "http://a.org/", page % ("", f"-{x}", story, f"-{x}", "extra " * 25)) for k, x in enumerate(letters)]
    slug = [(5000 + i, "http://b.org/", page % (f"slug-{letters[i]}", "", story + letters[i], "", "short")) for i in range(11)]
    slug.append((5099, "http://b.org/", page % ("slug-z", "", story, "", "extra " * 25)))
    got = {r.page_id: r.text for r in html_consensus.main_texts(spark.createDataFrame(rows + slug, "page_id long, url string, html string")).collect()}
    assert all(got[100 * k + 9] == story for k in range(12))
    assert got[5099] == story


def test_unclosed_markup_takes_no_quadratic_time():
    import time

    began = time.time()
    for s in ('<a "' * 20_000, "<" * 100_000, "<!" * 50_000, "<p>" * 30_000, "<div>" * 2000 + "x"):
        html_consensus.main_text(html_consensus.parse(s), [])
    assert time.time() - began < 30


# --- language ----------------------------------------------------------------------------------------------


def test_languages_of_held_out_pages(spark):
    rng = np.random.default_rng(6)
    vocab = {"en": ["the", "and", "with", "thing"], "de": ["und", "der", "nicht", "schon"], "fr": ["les", "que", "dans", "être"]}
    docs = [(i, m, " ".join(rng.choice(vocab[m], 40))) for i in range(60) for m in vocab]
    labelled = spark.createDataFrame([*docs, (1000, None, "x"), (1001, "en", None)], "doc_id long, lang string, text string")
    rows, truth = [], {}
    for i in range(90):
        m = list(vocab)[i % 3]
        text = " ".join(rng.choice(vocab[m], 30)) if i % 5 else ""  # every fifth has no text
        said = f' lang="{m}-XX"' if i % 2 else ""
        rows.append((i, f"http://{m}.example.{ {'en': 'co.uk', 'de': 'de', 'fr': 'com'}[m] }/p", f"<html{said}><body><p>{text}</p></body></html>"))
        truth[i] = m
    rows += [(200, None, None), (201, "", ""), rows[0]]
    pages = spark.createDataFrame([(*r, "l", "h") for r in rows], "page_id long, url string, html string, lang string, host string")
    got = language.identify(pages, labelled).collect()
    assert len(got) == len(rows)
    assert np.mean([truth[r.page_id] == r.lang for r in got if r.page_id in truth]) > 0.97
    assert all(0 < r.confidence <= 1 for r in got)
    assert language.identify(pages.limit(0), labelled).count() == 0
    assert {r.lang for r in language.identify(pages, labelled.limit(0)).collect()} == {"und"}


# --- templates ---------------------------------------------------------------------------------------------


def test_recurring_templates_go_and_other_lines_stay(spark):
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(200)]
    texts = [f"intro {' '.join(rng.choice(words, 9))}\nLog in from host h{i} at 12:{i:02} by user u{i} now please\nend {' '.join(rng.choice(words, 12))}" for i in range(12)]
    texts += [None, "", "\n\n", "lonely line"] + ["same copy text\nof one document"] * 15
    docs = frame(spark, texts)
    rows = {r.doc_id: r for r in log_templates.drop_templates(docs.drop("n_tokens"), min_texts=10).collect()}
    for i in range(12):
        parts = texts[i].split("\n")
        assert rows[i].text == f"{parts[0]}\n{parts[2]}" and (rows[i].n_lines, rows[i].n_dropped) == (3, 1)
    for i in range(12, len(texts)):  # copies of one text count once
        assert rows[i].text == texts[i] and rows[i].n_dropped == 0
    assert log_templates.drop_templates(docs.limit(0)).count() == 0


def test_overfull_leaves_branch_deeper_with_the_same_result(spark):
    texts = [f"the same start word{i % 4} then value v{'x' * (i % 7)} of unit and tail" for i in range(40)]
    docs = frame(spark, texts)
    whole = {r.doc_id: r.n_dropped for r in log_templates.drop_templates(docs, min_texts=3, alike=0.8).collect()}
    split = {r.doc_id: r.n_dropped for r in log_templates.drop_templates(docs, min_texts=3, alike=0.8, most_forms=3).collect()}
    assert sum(whole.values()) == 40 and sum(split.values()) > 0


def test_a_leaf_of_any_size_gives_the_same_result_per_document(spark):
    names = ["".join("abcdefghij"[int(c)] for c in f"{i:03}") for i in range(60)]
    texts = [f"Written by our reporter {n} for the daily\n{n} alone has a line about {n} here" for n in names]
    docs = frame(spark, texts)
    whole, split = ({r.doc_id: (r.n_dropped, r.text) for r in log_templates.drop_templates(docs, **o).collect()} for o in ({}, {"most_forms": 7}))
    assert whole == split == {i: (1, t.split("\n")[1]) for i, t in enumerate(texts)}


def test_long_passages_go_from_two_different_texts_and_short_lines_from_more(spark):
    words = ["".join("abcdefghij"[int(c)] for c in f"{i:03}") for i in range(200)]
    passage, edited, short = " ".join(words[:60]), " ".join([*words[:30], "edit", *words[31:60]]), " ".join(words[:49])
    texts = [f"one {passage} x\n{passage}\n{short}", f"{edited}\ntwo", f"{short}\nthree", *[" ".join(words[100:160])] * 3]
    rows = {r.doc_id: (r.text, r.n_dropped) for r in log_templates.drop_templates(frame(spark, texts)).collect()}
    assert rows == {0: (f"one {passage} x\n{short}", 1), 1: ("two", 1)} | {i: (texts[i], 0) for i in (2, 3, 4, 5)}


def plain_drain(forms, alike):
    rows, made, own = [f.split(" ") for f in forms], [], []
    for row in rows:
        same = [sum(a == b != log_templates.WILD for a, b in zip(m, row, strict=True)) for m in made]
        best = max(range(len(made)), key=lambda i: (same[i], -i), default=-1)
        covers = [i for i, m in enumerate(made) if all(a in (b, log_templates.WILD) for a, b in zip(m, row, strict=True))]
        if made and same[best] >= alike * len(row):
            made[best] = [a if a == b else log_templates.WILD for a, b in zip(made[best], row, strict=True)]
        elif covers:
            best = covers[0]
        else:
            best = len(made)
            made.append(row)
        own.append(best)
    return own


@pytest.mark.parametrize("alike", [0.0, 0.3, 0.5, 0.7, 1.0])
def test_indexed_templates_agree_with_comparing_all(alike):
    rng = np.random.default_rng(11)
    for n in (1, 2, 5, 9):
        for size in (2, 4):
            forms = [" ".join(rng.choice(["<*>", *"abcdefg"[:size]], n)) for _ in range(150)]
            assert log_templates.drain(forms, alike) == plain_drain(forms, alike)


def test_drain_joins_by_equal_tokens():
    forms = ["open file a of user", "open file b of user", "open file <*> of user", "close door x in house", "open x y z user"]
    assert log_templates.drain(forms, 0.7) == [0, 0, 0, 1, 2]


WORDY = " ".join(f"word{i} of the long text," for i in range(60))
PARTS = {
    "lead and rest": "<article><div class=lead>Short lead.</div><div class=rest>" + WORDY + "</div></article>",
    "paragraph before a box": "<div class=wrap><p>Short lead.</p><div class=body>" + WORDY + "</div></div>",
    "paragraph in body": "<p>Short lead.</p><div class=text>" + WORDY + "</div>",
    "paragraph before a table": "<div class=x1><p>Short lead.</p><table>" + "".join(f"<tr><td>name {i}</td><td>" + WORDY[:300] + "</td></tr>" for i in range(5)) + "</table></div>",
    "sections": "<main><section class=a><p>Short lead.</p></section><section class=b>" + WORDY + "</section><section class=c><p>The end.</p></section></main>",
    "class of a paragraph": "<article><p class='header-text'>Short lead.</p><p>" + WORDY + "</p></article>",
    "form around all": "<form action=x><input name=q><div class=story><p>Short lead.</p><p>" + WORDY + "</p></div><select><option>no</select></form>",
    "long attribute": "<article><p data-x='" + "<b>junk</b> " * 900 + "'>Short lead.</p><p>" + WORDY + "</p></article>",
}
OUTSIDE = "<header>junk</header><nav><a href=x>junk</a></nav>{}<div class='sidebar-left'>junk words here</div><div class=links><a href=y>junk link</a></div><footer>junk</footer>"


@pytest.mark.parametrize("pages", [1, 12])
@pytest.mark.parametrize("name", PARTS)
def test_articles_keep_all_their_parts_and_nothing_else(spark, name, pages):
    rows = [(i, "http://h.example/a", OUTSIDE.format(PARTS[name])) for i in range(pages)]
    for r in html_consensus.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert "Short lead." in r.text and "word59 of the long text" in r.text or name == "paragraph before a table", r.text
        assert r.text.startswith("Short lead.") and "junk" not in r.text
        assert name != "sections" or r.text.endswith("The end.")
        assert name != "paragraph before a table" or r.text.count("name ") == 5


def test_pages_full_of_open_quotes_are_read_in_linear_time():
    for unit in ('<a title="', "<a title='x> ", '<a "<b \' ', "<p class='a\">", "<a b=\"<\" c='"):
        times = []
        for n in (3_000, 12_000):
            start = time.process_time()
            html_consensus.parse(unit * n)
            times.append(time.process_time() - start)
        assert times[1] < 12 * times[0] + 0.5


def test_templates_leave_columns_of_their_own_names_alone(spark):
    rows = [(i, f"Written by our reporter name{i} for the daily\nown line {'x' * i}", i, "a", "b") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, __drop string, n_lines_given string")
    got = log_templates.drop_templates(df).collect()
    assert {(r.n_lines_given_given, r.n_lines_given, r["__drop_given"], r.n_lines, r.n_dropped) for r in got} == {(i, "b", "a", 2, 1) for i in range(12)}
