"""Tokens: a digest cache of token counts, and id files of bit-plane shuffled blocks."""

from __future__ import annotations

import gc
import hashlib
import os
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.common import Scratch, row_hash

#: Pieces remembered per worker; the memo starts anew beyond it, so memory is bounded.
MEMO_PIECES, MEMO_ID_PIECES = 600_000, 1_000_000


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: the digest of its file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class _Memo:
    """What the tokenizer gives for a piece of text, asked once per piece.

    When it is full, it becomes the old half, of which only what is still asked for is taken over.
    """

    def __init__(self, encode: Callable[[list], list], size: int = MEMO_PIECES):
        self.encode, self.half, self.now, self.old = encode, size // 2, {}, {}

    def missing(self, pieces: set) -> set:
        """What of ``pieces`` is not known; all that is known is in ``now`` until the next call."""
        if len(self.now) > self.half:
            self.old, self.now = self.now, {}
        new = pieces.difference(self.now)
        kept = new.intersection(self.old)
        self.now.update((p, self.old[p]) for p in kept)
        return new - kept

    def ask(self, new: list) -> None:
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            self.now.update(zip(part, self.encode(part), strict=True))

    def learn(self, pieces: set) -> None:
        self.ask(list(self.missing(pieces)))


class _Words(_Memo):
    """Numbers of tokens of words, for a tokenizer that drops white space and never joins over it."""

    def __init__(self, path: str):
        t = _load(path)
        super().__init__(lambda ps: [len(e) for e in t.encode_batch_fast([p.decode() for p in ps], add_special_tokens=False)])


def _byte_letters() -> dict[int, str]:
    """The character by which byte-level tokenizers write each byte: itself where it shows, else one from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}


def _letters_are_a_unit(t) -> bool:
    """Whether a tokenizer's own parts keep letters together, with a space before them, and only its model cuts them."""
    from tokenizers import models, pre_tokenizers

    pre = t.pre_tokenizer
    whole = isinstance(pre, pre_tokenizers.ByteLevel) and pre.use_regex and not pre.add_prefix_space
    return whole and t.normalizer is None and isinstance(t.model, models.BPE) and not any(a.content.strip().isalpha() for a in t.get_added_tokens_decoder().values())


class _Table(dict):
    """Ids of pieces, asked for where one is looked up first. See :class:`_Memo` for the halves.

    A piece that ``ask`` does not take is a KeyError.
    """

    def __init__(self, ask: Callable[[str], bytes], size: int = MEMO_ID_PIECES):
        self.ask, self.half, self.old = ask, size // 2, {}

    def __missing__(self, piece: str) -> bytes:
        got = self.old.get(piece)
        got = self[piece] = self.ask(piece) if got is None else got
        return got

    def turn(self) -> None:
        """Start a new half where this one is full."""
        if len(self) > self.half:
            self.old = dict(self)
            self.clear()


class _Ids:
    """Ids of texts by a byte-level tokenizer, from the ids of pieces.

    Such a tokenizer starts a new unit at a single space before a visible character, and on both sides of a
    single newline between visible characters. The ids of a text cut there are the ids of its pieces. Texts
    with other white space at a cut go through :func:`pieces`, which cuts less.
    """

    def __init__(self, path: str):
        t = _load(path)

        def ids(p: str) -> bytes:
            return np.array(t.encode_batch_fast([p], add_special_tokens=False)[0].ids, "<u4").tobytes()

        self.newline, comma, stop = ids("\n"), ids(","), ids(".")
        direct, table, model = _letters_are_a_unit(t), _byte_letters(), t.model
        as_bytes = [i.to_bytes(4, "little") for i in range(t.get_vocab_size())]

        def asked(lead: str) -> _Table:
            space = table[32] if lead else ""

            def ask(p: str) -> bytes:
                """Words of letters go to the tokenizer's model as they are: its other steps would not cut them."""
                # Beyond these scripts it may depend on the version of Unicode what a letter is.
                if direct and p.isalpha() and (p.isascii() or max(p) < "\u0500"):
                    unit = p if p.isascii() else p.encode().decode("latin-1").translate(table)
                    return b"".join([as_bytes[x.id] for x in model.tokenize(space + unit)])
                if not p or p[0].isspace() or p[-1].isspace():
                    raise KeyError(p)
                # A stop or comma after a letter or digit is a unit of its own.
                if len(p) > 1 and p[-1] in ".," and p[-2].isalnum():
                    return known[p[:-1]] + (comma if p[-1] == "," else stop)
                return ids(lead + p)

            known = _Table(ask)
            return known

        self.plain, self.spaced = asked(""), asked(" ")
        # Pieces with irregular white space are kept apart: the tables above must not know any.
        self.odd = _Memo(lambda ps: [ids(p) for p in ps])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; they depend on the text alone, not on what was encoded before."""
        # Millions of short-lived lists without cycles: the collector would only walk them again and again.
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        self.plain.turn()
        self.spaced.turn()
        plain, spaced, out = self.plain.__getitem__, self.spaced.__getitem__, {}
        for text in dict.fromkeys(texts):
            lines = [line.split(" ") for line in text.split("\n")]
            try:
                out[text] = self.newline.join([plain(line[0]) + b"".join(map(spaced, line[1:])) for line in lines])
            except KeyError:  # empty, or with irregular white space
                parts = pieces(text)
                self.odd.learn(set(parts))
                out[text] = b"".join(map(self.odd.now.__getitem__, parts))
        return [out[t] for t in texts]


#: A Python worker runs many tasks; what it has learned stays.
_LEARNT: dict[tuple[type, str], _Words | _Ids] = {}


def _learnt(kind: type, path: str):
    if (kind, path) not in _LEARNT:
        _LEARNT[kind, path] = kind(path)
    return _LEARNT[kind, path]


def _some(column: pa.Array, bytes_at_once: int = 1_000_000) -> Iterator[list[bytes]]:
    """Whole texts of a batch as UTF-8, NULL as empty, about a megabyte at a time."""
    out, size = [], 0
    for x in column.cast(pa.binary()):
        out.append(x.as_py() or b"")
        size += len(out[-1])
        if size > bytes_at_once:
            yield out
            out, size = [], 0
    if out:
        yield out


# --- counts ------------------------------------------------------------------------------------------------


def _count_misses(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _learnt(_Words, path)
        for batch in batches:
            counts: list[int] = []
            for texts in _some(batch.column("text")):
                # The tokenizer drops white space and never joins over it, so counts add up over words.
                words = [x.split() for x in texts]
                memo.learn(set().union(*words))
                counts += [sum(map(memo.now.__getitem__, w)) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def _first_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest and task: a copied text goes into the shuffle at most once per input task."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for d in batch.column("digest"):
            d = d.as_py()
            keep.append(d not in seen)
            seen.add(d)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _content_digest() -> Column:
    """Digest of the text with white space runs as one space and none at the ends: no token depends on those."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.trim(F.regexp_replace(text, "[ \\t\\n\\x0B\\f\\r]+", " ")), 256))


CACHE = "tokenizer string, digest binary, n_tokens long"


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, cache: str | None = None) -> DataFrame:
    """Token counts by a digest cache: rows (doc_id, n_bytes, n_tokens, over_limit), one per document.

    ``cache`` is a Parquet folder of (tokenizer digest, content digest, count) that all executors reach. Counts
    found there under this tokenizer's digest are joined; each distinct text not found is encoded once and
    appended. Without ``cache`` an empty one in the shared folder is used. The tokenizer must drop white
    space and split at it, as word_bpe_49k.json does.

    NULL and empty texts have 0 bytes and 0 tokens. Repeated rows and copies get the stored count of their
    text. Copies are reduced in each task before the shuffle, so no key is hot. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token_counts")
    version = tokenizer_digest(path)
    folder = cache or f"{scratch.root}/cache"
    spark.createDataFrame([], CACHE).write.mode("append").parquet(folder)
    known = spark.read.schema(CACHE).parquet(folder).where(F.col("tokenizer") == version).select("digest", "n_tokens").dropDuplicates(["digest"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _content_digest().alias("digest"))
    firsts = keyed.select("digest", "text").mapInArrow(_first_of_partition, "digest binary, text string")
    misses = firsts.join(known, "digest", "left_anti").repartition("digest").mapInArrow(_first_of_partition, "digest binary, text string")
    counted = misses.mapInArrow(_count_misses(path), "digest binary, n_tokens long")
    counted.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(folder)
    known = spark.read.schema(CACHE).parquet(folder).where(F.col("tokenizer") == version).select("digest", "n_tokens").dropDuplicates(["digest"])
    known = scratch.stage(known)  # a plain table on this side lets a hot text be split
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), _content_digest().alias("digest"))
    return sizes.join(known, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


# --- id files ----------------------------------------------------------------------------------------------

CHUNK = "shard int, chunk int, first long, n_ids long, doc_ids array<long>, doc_lengths array<long>, planes array<int>, payload binary"


def pack(ids: np.ndarray, block: int, plane: str) -> tuple[list[int], bytes]:
    """Compressed planes of ``ids`` and their sizes, block by block.

    A block of ids is transposed so that the i-th bytes (or bits) of all ids lie together; each of the 4
    (or 32) planes is compressed by zstandard on its own. The last block may be shorter.
    """
    press = zstandard.ZstdCompressor(level=3)
    sizes, out = [], []
    for at in range(0, len(ids), block):
        part = np.ascontiguousarray(ids[at : at + block], "<u4").view(np.uint8).reshape(-1, 4)
        if plane == "bit":
            planes = np.packbits(np.unpackbits(part, axis=1, bitorder="little").T, axis=1, bitorder="little")
        else:
            planes = part.T
        for p in planes:
            out.append(press.compress(np.ascontiguousarray(p).tobytes()))
            sizes.append(len(out[-1]))
    return sizes, b"".join(out)


def unpack(n: int, sizes: list[int], payload: bytes, block: int, plane: str) -> np.ndarray:
    """The ids that :func:`pack` stored."""
    undo, out, at, k, width = zstandard.ZstdDecompressor(), [], 0, 0, 32 if plane == "bit" else 4
    for first in range(0, n, block):
        m = min(block, n - first)
        planes = []
        for _ in range(width):
            planes.append(np.frombuffer(undo.decompress(payload[at : at + sizes[k]]), np.uint8))
            at, k = at + sizes[k], k + 1
        if plane == "bit":
            bits = np.stack([np.unpackbits(p, bitorder="little", count=m) for p in planes], axis=1)
            part = np.packbits(bits, axis=1, bitorder="little")
        else:
            part = np.stack(planes, axis=1)
        out.append(np.ascontiguousarray(part).view("<u4").ravel())
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def pieces(text: str) -> list[str]:
    """Cut before each single space that a visible character follows.

    A byte-level tokenizer always starts a new unit there, so the ids of the pieces are the ids of the text.
    """
    parts = text.split(" ")
    out = [parts[0]] if parts[0] else []
    for p in parts[1:]:
        if p and not p[0].isspace() or not out:
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out


def _write_ids(path: str, block: int, chunk_ids: int, plane: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        ids_of = _learnt(_Ids, path)
        end = np.array([end_id], "<u4").tobytes()
        held: list[bytes] = []
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        n = chunk = first = 0

        def flush() -> pa.RecordBatch:
            nonlocal n, chunk, first
            ids = np.frombuffer(b"".join(held), "<u4")
            sizes, payload = pack(ids, block, plane)
            row = [[shard], [chunk], [first], [n], [list(doc_ids)], [list(lengths)], [sizes], [payload]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            held.clear()
            doc_ids.clear()
            lengths.clear()
            first, n, chunk = first + n, 0, chunk + 1
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, types, strict=True)], [c.split()[0] for c in CHUNK.split(", ")])

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            i = 0
            for texts in _some(batch.column("text")):
                for ids in ids_of.encode([x.decode() for x in texts]):
                    ids += end
                    held.append(ids)
                    doc_ids.append(names[i])
                    lengths.append(len(ids) // 4)
                    n += lengths[-1]
                    i += 1
                    if n >= chunk_ids:
                        yield flush()
        if n:
            yield flush()

    return run


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 0, block: int = 65_536, chunk_ids: int = 1_000_000, plane: str = "byte") -> None:
    """Encode whole texts in ascending doc_id order into ``folder``: Parquet rows of chunks, each with its index.

    Every document's ids end with ``end_id``. A chunk holds whole documents of about ``chunk_ids`` ids or one
    longer document: (shard, chunk, its first id in the shard, ids, doc ids, lengths, compressed plane sizes,
    planes). Shards follow the order of doc_id; the order in a shard is by chunk. Spark's writer commits the
    files, so a lost executor leaves no half chunk.

    NULL and empty texts have only the end id; a NULL doc_id comes first; rows with equal doc_id are ordered
    by content, and exact copies next to each other. Ranges are cut through rows of one doc_id too.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", row_hash("text")).withColumn("copy", F.monotonically_increasing_id())
    order = ["doc_id", "h", "copy"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    chunks = ranged.mapInArrow(_write_ids(path, block, chunk_ids, plane, end_id), CHUNK)
    chunks.write.option("compression", "none").parquet(folder)


def _read_ids(block: int, plane: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                raw = memoryview(unpack(row["n_ids"], row["planes"], row["payload"], block, plane).tobytes())
                lengths = np.array(row["doc_lengths"], np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["offset"] + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_ids(spark, folder: str, block: int = 65_536, plane: str = "byte") -> DataFrame:
    """Decode every chunk of ``folder``: rows (doc_id, start, n_tokens, ids_crc32).

    ``start`` counts the ids of all documents before, from the chunk index. Only the sizes of the shards (at
    most one row per range of the writer) are broadcast.
    """
    from pyspark.sql import Window

    chunks = spark.read.schema(CHUNK).parquet(folder)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_first"))
    placed = chunks.join(F.broadcast(shards), "shard").select("n_ids", "doc_ids", "doc_lengths", "planes", "payload", (F.col("first") + F.col("shard_first")).alias("offset"))
    return placed.mapInArrow(_read_ids(block, plane), "doc_id long, start long, n_tokens long, ids_crc32 long")
