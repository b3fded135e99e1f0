"""Fill-in-the-middle: texts cut at unit boundaries that a wavelet matrix finds, and put in another order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Classes of characters: line feed, other ASCII blank, end of a sentence, anything else.
LINE_FEED, BLANK, STOP, OTHER = 0, 1, 2, 3
#: A unit ends after each character of these classes; what follows the last one is a unit too.
UNITS = {"line": (LINE_FEED,), "sentence": (LINE_FEED, STOP), "word": (LINE_FEED, BLANK)}
MARKS = ("<P>", "<S>", "<M>")
_CLASS = np.full(128, OTHER, np.uint8)
_CLASS[[ord(c) for c in "\t\x0b\x0c\r "]] = BLANK
_CLASS[[ord(c) for c in ".!?"]] = STOP
_CLASS[ord("\n")] = LINE_FEED
_CHUNK = 1 << 22
_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class _Bits:
    """A bit vector that counts the ones before any position in constant time."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of symbols below ``2 ** bits``: one bit vector per bit, each level sorted by the bits above."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for shift in range(bits - 1, -1, -1):
            bit = (symbols >> shift) & 1
            self.levels.append(_Bits(bit))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each position."""
        low, high = np.zeros_like(at), at
        for level, shift in zip(self.levels, range(self.bits - 1, -1, -1), strict=True):
            if symbol >> shift & 1:
                low, high = level.zeros + level.ones(low), level.zeros + level.ones(high)
            else:
                low, high = low - level.ones(low), high - level.ones(high)
        return high - low

    def count(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How often any of ``symbols`` occurs before each position."""
        return sum(self.rank(s, at) for s in symbols)

    def bisect(self, symbols: tuple[int, ...], start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The first positions from ``start`` with ``k`` of ``symbols`` before them, ``end`` where there are fewer."""
        base, low, high = self.count(symbols, start), start.copy(), end.copy()
        while (low < high).any():
            mid = (low + high) >> 1
            enough = self.count(symbols, mid) - base >= k
            low, high = np.where(enough | (low >= high), low, mid + 1), np.where(enough, mid, high)
        return low


def cuts(texts: list[str], unit: str, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and the characters before its first and second cut.

    The texts are one sequence of classes under one wavelet matrix. The first cut comes after the smaller of
    ``h1`` and ``h2`` modulo units + 1, the second after the larger.
    """
    symbols = UNITS[unit]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    matrix = WaveletMatrix(np.where(codes < 128, _CLASS[np.minimum(codes, 127)], np.uint8(OTHER)).astype(np.uint8), 2)
    sizes = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(sizes)
    start = end - sizes
    ends = matrix.count(symbols, end) - matrix.count(symbols, start)
    last = matrix.count(symbols, end) - matrix.count(symbols, np.maximum(end - 1, start))
    n = ends + ((sizes > 0) & (last == 0))
    a, b = h1 % (n + 1), h2 % (n + 1)
    one, two = (matrix.bisect(symbols, start, end, k) - start for k in (np.minimum(a, b), np.maximum(a, b)))
    return n, one, two


def _runs(texts: list[str]) -> Iterator[slice]:
    """Slices of at most ``_CHUNK`` characters, or of one text."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if i > first and held + len(t) > _CHUNK:
            yield slice(first, i)
            first, held = i, 0
        held += len(t)
    if first < len(texts):
        yield slice(first, len(texts))


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """Each text as prefix, suffix and middle, marked: rows (doc_id, n, form, prefix_chars, middle_chars, output).

    Four numbers of the SHA-256 of seed and doc_id choose the cuts (two), whether the text is changed at all
    (``percent``) and the order: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` (``spm_percent``)
    is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. ``n`` counts units: a line, sentence or word ends after
    its last character (:data:`UNITS`). Cuts are found by ranks over a wavelet matrix of character classes; one
    matrix serves up to 4 million characters of a batch, and a longer text has one of its own.

    NULL texts count as empty. Empty texts and those that hold a mark stay ``plain``: output is the text,
    prefix_chars and middle_chars are NULL. A NULL doc_id is hashed as an empty one. Equal doc_ids draw equal
    numbers; equal rows give equal rows. Other columns are not read. An empty table gives no rows. Rows are
    independent of each other, so nothing is shuffled and a lost task repeats its rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *draws)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            h = [batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)]
            for run in _runs(texts):
                part = texts[run]
                n, one, two = cuts(part, unit, h[0][run], h[1][run])
                plain = [not t or any(m in t for m in MARKS) or h3 % 100 >= percent for t, h3 in zip(part, h[2][run], strict=True)]
                form, out = [], []
                for t, p, a, b, h4 in zip(part, plain, one.tolist(), two.tolist(), h[3][run].tolist(), strict=True):
                    if p:
                        form.append("plain")
                        out.append(t)
                    elif h4 % 100 < spm_percent:
                        form.append("spm")
                        out.append(f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}")
                    else:
                        form.append("psm")
                        out.append(f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}")
                mask = np.array(plain, bool)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[run], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(one, pa.int64(), mask=mask),
                     pa.array(two - one, pa.int64(), mask=mask), pa.array(out, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return rows.mapInArrow(cut, _OUT)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of. Marks cannot overlap, so the first of each is the one put in."""
    out, form_ = F.col(output), F.col(form)
    at = {m: F.locate(m, out) for m in MARKS}
    between = lambda a, b: F.substr(out, at[a] + 3, at[b] - at[a] - 3)
    rest = F.substr(out, at["<M>"] + 3)
    psm = F.concat(between("<P>", "<S>"), rest, between("<S>", "<M>"))
    spm = F.concat(between("<P>", "<M>"), rest, between("<S>", "<P>"))
    return F.when(form_ == "psm", psm).when(form_ == "spm", spm).otherwise(out)
