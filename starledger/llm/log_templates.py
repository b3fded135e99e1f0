"""Line deduplication by a fixed-depth tree of log templates."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from starledger.llm.common import Scratch, hash_filter, may_hold, row_hash, split_by

WILD = "<*>"
#: Tokens with digits, addresses or paths are variable fields.
_VARIABLE = re.compile(rb"[0-9@/\\]")
LINES = "doc_id long, text_hash long, line_no int, h1 long, h2 long, n int, leaf long, form string"


def form(line: bytes) -> bytes:
    """The tokens of a line with one space between them, variable ones generalised."""
    tokens = line.split()
    if _VARIABLE.search(line):
        tokens = [WILD.encode() if _VARIABLE.search(t) else t for t in tokens]
    return b" ".join(tokens)


def _parsed(depth: int, shown: bool):
    """A row per line with a token: two hashes of its form, its tokens, its leaf, and the form if it is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                at, number, forms, tokens = [], [], [], []
                for row, text in enumerate(part.column("text").cast(pa.binary())):
                    for i, line in enumerate(text.as_py().split(b"\n")):
                        f = form(line)
                        if f:
                            at.append(row)
                            number.append(i)
                            forms.append(f)
                hashes = b"".join(map(xxhash.xxh3_128_digest, forms))
                pairs = np.frombuffer(hashes, "<i8").reshape(-1, 2)
                tokens = [f.count(b" ") + 1 for f in forms]
                leaves = [xxhash.xxh3_64_digest(b"%d " % n + b" ".join(f.split(b" ", depth)[:depth])) for n, f in zip(tokens, forms, strict=True)]
                rows = pa.array(at, pa.int64())
                columns = [part.column(c).take(rows) for c in ("doc_id", "text_hash")]
                columns += [pa.array(number, pa.int32()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(tokens, pa.int32()), pa.array(np.frombuffer(b"".join(leaves), "<i8"))]
                columns.append(pa.array(forms, pa.binary()).cast(pa.string()) if shown else pa.nulls(len(forms), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in LINES.split(", ")])

    return run


def _lines(rows: DataFrame, depth: int, shown: bool) -> DataFrame:
    return rows.mapInArrow(_parsed(depth, shown), LINES)


class Leaf:
    """The templates of one leaf, built from its forms one at a time in the order given.

    A form joins the template with most equal tokens, if at least a share ``alike`` is equal; what differs
    becomes a wildcard. Otherwise it starts a template. An index of templates by position and token finds
    all that can reach the share, so that the forms need not meet and only templates are held.
    """

    def __init__(self, n: int, alike: float):
        self.n, self.count = n, 0
        self.least = next((k for k in range(n + 1) if k >= alike * n), n + 1)
        self.number: dict[str, int] = {WILD: -1}
        self.made = np.empty((8, n), np.int64)
        self.at: list[dict[int, list[int]]] = [{} for _ in range(n)]
        # Templates of too few tokens to be joined by share never change: looked up by their fixed tokens.
        self.loose: dict[tuple[int, ...], dict[tuple[int, ...], int]] = {}

    def _near(self, row: list[int], fixed: list[int]) -> np.ndarray:
        if self.least <= 0:
            return np.arange(self.count)
        if len(fixed) < self.least:
            return np.empty(0, np.int64)
        # At most len(fixed) - least of the fixed tokens may differ, so one more of them holds an equal one.
        lists = sorted((self.at[i].get(row[i], []) for i in fixed), key=len)[: len(fixed) - self.least + 1]
        return np.unique(np.array([t for part in lists for t in part], np.int64))

    def add(self, form: str) -> int:
        """The number of the form's template."""
        row = [self.number.setdefault(t, len(self.number)) for t in form.split(" ")]
        # A wildcard is never equal, so that templates do not grow ever more general.
        fixed = [i for i, t in enumerate(row) if t >= 0]
        near = self._near(row, fixed)
        if len(near):
            values = np.array(row)
            same = ((self.made[near] == values) & (values >= 0)).sum(1)
            best = int(same.argmax())
            if same[best] >= self.least:
                own = int(near[best])
                self.made[own] = np.where(self.made[own] == values, values, -1)
                return own
        found = [part.get(tuple(row[i] for i in places)) for places, part in self.loose.items()]
        if any(t is not None for t in found):
            return min(t for t in found if t is not None)
        own, self.count = self.count, self.count + 1
        if own == len(self.made):
            self.made = np.concatenate([self.made, np.empty_like(self.made)])
        self.made[own] = row
        for i in fixed:
            self.at[i].setdefault(row[i], []).append(own)
        if len(fixed) < self.least:
            self.loose.setdefault(tuple(fixed), {})[tuple(row[i] for i in fixed)] = own
        return own


def drain(forms: list[str], alike: float) -> list[int]:
    """Number of the template of each form, forms of equal length in the order given."""
    leaf = Leaf(forms[0].count(" ") + 1 if forms else 0, alike)
    return [leaf.add(f) for f in forms]


def _templates(alike: float, most_forms: int):
    """The template of each form; rows come by leaf, in the order in which the leaf takes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaf, names = None, None, []
        for batch in batches:
            for start in range(0, batch.num_rows, most_forms):
                part = batch.slice(start, most_forms)
                found = []
                for k, form in zip(part.column("leaf").to_pylist(), part.column("form").to_pylist(), strict=True):
                    if k != key:
                        key, leaf, names = k, Leaf(form.count(" ") + 1, alike), []
                    own = leaf.add(form)
                    if own == len(names):
                        names.append(xxhash.xxh3_64_intdigest(form.encode()) - 2**63)
                    found.append(names[own])
                columns = [part.column(c) for c in ("h1", "h2", "leaf")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64())], ["h1", "h2", "t1", "t2"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts, lines, gone = [], [], []
        for text, drop in zip(batch.column("text"), batch.column("__drop"), strict=True):
            text, drop = text.as_py(), set(drop.as_py() or ())
            parts = text.split("\n") if text is not None else []
            texts.append("\n".join(x for i, x in enumerate(parts) if i not in drop) if drop else text)
            lines.append(len(parts))
            gone.append(len(drop))
        columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(gone, pa.int64())], [*batch.schema.names[:-1], "n_lines", "n_dropped"])


def _given(columns: list[str]) -> dict[str, str]:
    """New names for columns whose names the operator uses itself."""
    names, out = set(columns), {}
    for c in columns:
        if c in ("n_lines", "n_dropped", "__drop", "__id", "__hash"):
            new = f"{c}_given"
            while new in names:
                new += "_given"
            names.add(new)
            out[c] = new
    return out


def drop_templates(docs: DataFrame, min_texts: int = 10, depth: int = 3, alike: float = 0.7, most_forms: int = 1000, long_tokens: int = 50, long_texts: int = 2) -> DataFrame:
    """``docs`` without the lines of templates that recur in at least ``min_texts`` different texts.

    Templates of ``long_tokens`` tokens or more are passages rather than turns of phrase: they go from
    ``long_texts`` different texts on. Lines are cut at newlines, tokens at ASCII white space. The tree's leaves are lines of equal token count and
    equal ``depth`` leading tokens, after tokens with digits, addresses or paths became wildcards. Forms of a
    leaf join templates by their share of equal tokens, those of most texts first. A leaf of any size is one
    leaf: its forms are streamed in slices of at most ``most_forms``, which never change the result. Exact
    copies of a text count once.

    All columns stay; ``text`` is replaced and ``n_lines``, ``n_dropped`` are added. Columns that have these names
    already, or one of the operator's own, keep their values under the name with ``_given`` after it. NULL texts stay NULL with 0 lines; empty texts and lines without tokens stay. Documents
    whose every line goes keep an empty text. Repeated rows are cut alike. An empty table gives no rows.
    """
    docs = docs.withColumnsRenamed(_given(docs.columns))
    scratch = Scratch(docs.sparkSession, "templates")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash("text").alias("text_hash"), F.col("text").cast("string").alias("text")).where("text <> ''")
    keys = scratch.stage(_lines(rows, depth, False).select("doc_id", "text_hash", "line_no", "h1", "h2", "n", "leaf"))
    enough = F.col("texts") >= F.when(F.col("n") >= long_tokens, F.least(F.lit(long_texts), F.lit(min_texts))).otherwise(F.lit(min_texts))
    frequent = keys.select("leaf", "n", "text_hash").distinct().groupBy("leaf", "n").agg(F.count(F.lit(1)).alias("texts")).where(enough)
    frequent = scratch.stage(frequent.select("leaf"))
    # Lines of leaves that a bitmap clears go where they are read; only the others meet the exact list of leaves.
    seen = scratch.stage(hash_filter(frequent.select(F.col("leaf").alias("h"))))
    open_leaves = lambda lines: may_hold(lines.withColumn("h", F.col("leaf")), seen, "open").where("open").drop("h", "open")
    alive = scratch.stage(open_leaves(keys).join(frequent, "leaf", "left_semi"))
    scratch.release(keys)
    texts = alive.select("leaf", "h1", "h2", "text_hash").distinct().groupBy("leaf", "h1", "h2").agg(F.count(F.lit(1)).alias("texts"))
    shown = open_leaves(_lines(rows, depth, True).select("leaf", "h1", "h2", "n", "form"))
    forms = shown.groupBy("h1", "h2").agg(F.min("form").alias("form"), F.min("n").alias("n")).join(texts, ["h1", "h2"])
    forms = scratch.stage(forms)
    scratch.release(frequent)
    # A leaf's forms pass through one task in order; it holds the leaf's templates, never its forms.
    ordered = forms.select("leaf", "texts", "h1", "h2", "form").repartition("leaf").sortWithinPartitions("leaf", F.col("texts").desc(), "form", "h1", "h2")
    named = scratch.stage(ordered.mapInArrow(_templates(alike, most_forms), "h1 long, h2 long, t1 long, t2 long"))
    scratch.release(forms, seen)
    marked = scratch.stage(alive.join(named, ["h1", "h2"]).select("doc_id", "text_hash", "line_no", "n", "t1", "t2"))
    scratch.release(alive, named)
    often = marked.select("t1", "t2", "n", "text_hash").distinct().groupBy("t1", "t2", "n").agg(F.count(F.lit(1)).alias("texts")).where(enough)
    often = scratch.stage(often.select("t1", "t2"))  # a plain table on this side lets a hot template be split
    gone = marked.join(often, ["t1", "t2"], "left_semi").groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.collect_set("line_no").alias("__drop"))
    gone = scratch.stage(gone)
    scratch.release(marked, often)
    clear, rest = split_by(docs.withColumn("text", F.col("text").cast("string")), gone, row_hash("text"), scratch)
    lines = gone.select(F.col("__id").alias("id"), F.col("__hash").alias("hash"), "__drop")
    cut = rest.join(lines, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__hash") == F.col("hash")), "left").select("row.*", "__drop")
    wide = clear.withColumn("__drop", F.lit(None).cast("array<int>")).unionByName(cut)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema.fields[:-1])
    return wide.mapInArrow(_cut, f"{schema}, n_lines long, n_dropped long")
