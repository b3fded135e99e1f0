"""Shared pieces: staged tables, row keys, dense ranks over any order, connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starledger.session import scratch_path

#: The byte class of the contracts: words are maximal runs of anything but these.
BLANKS = b" \t\n\x0b\x0c\r"
#: bitmap_construct_agg makes bitmaps of this many bits.
_BITS = 32768


class Scratch:
    """Tables written to the shared folder to cut lineage, removed when they are no longer read.

    A lost executor costs a reread of files, never a recomputation of the plan before them.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.n = spark, scratch_path(spark, label), 0
        self.paths: dict[int, str] = {}

    def stage(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return it as read back."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._scratch = self  # keeps ids unique while the frame lives
        return out

    def release(self, *frames: DataFrame) -> None:
        """Delete staged tables that nothing reads any more."""
        for df in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def row_hash(*columns: str) -> Column:
    """64 bits that tell rows apart by content; NULL differs from the empty text."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def hash_filter(keys: DataFrame, buckets: int = 1024) -> DataFrame:
    """A bitmap over the hashes ``h`` in ``keys``: at most ``buckets`` rows of 4 KB, whatever the input holds."""
    place = keys.select(F.pmod("h", F.lit(buckets)).alias("bucket"), F.pmod(F.shiftrightunsigned("h", 20), F.lit(_BITS)).alias("bit"))
    return place.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def may_hold(df: DataFrame, seen: DataFrame, name: str, buckets: int = 1024) -> DataFrame:
    """Add ``name``: whether the bitmap has the hash ``h``. True for every hash it was made of, false for most others."""
    bit = F.pmod(F.shiftrightunsigned("h", 20), F.lit(_BITS))
    byte = F.conv(F.hex(F.expr(f"substring(bitmap, cast(pmod(shiftrightunsigned(h, 20), {_BITS}) div 8 as int) + 1, 1)")), 16, 10).cast("long")
    hit = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    joined = df.withColumn("bucket", F.pmod("h", F.lit(buckets))).join(F.broadcast(seen), "bucket", "left")
    return joined.withColumn(name, hit).drop("bucket", "bitmap")


def split_by(docs: DataFrame, found: DataFrame, hashed: Column, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two parts: rows surely without a row of ``found`` (__id, __hash), and rows that may have one.

    A row belongs to the one of its doc_id and its hash ``hashed``. The first part has the columns of ``docs``; the
    second has them in ``row``, beside ``__id`` and ``__hash``, so that only it need be joined: texts that a
    bitmap of 4 MB clears never enter a shuffle. ``docs`` is read once per part.
    """
    seen = scratch.stage(hash_filter(found.select(F.xxhash64("__id", "__hash").alias("h"))))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("__id"), hashed.alias("__hash"))
    rows = may_hold(rows.withColumn("h", F.xxhash64("__id", "__hash")), seen, "open").drop("h")
    return rows.where("not open").select("row.*"), rows.where("open").drop("open")


def without(docs: DataFrame, gone: DataFrame, hashed: Column, scratch: Scratch, stays: DataFrame | None = None) -> DataFrame:
    """``docs`` without the rows of ``gone`` (__id, __hash), whatever else their columns are called.

    ``stays`` has all the other rows in the same form, where the caller knows them. A row that the bitmap of those
    does not hold is one of ``gone`` and drops out where it is read; only rows that both bitmaps hold are joined.
    """
    gone = scratch.stage(gone.distinct())
    clear, rest = split_by(docs, gone, hashed, scratch)
    if stays is not None:
        seen = scratch.stage(hash_filter(stays.select(F.xxhash64("__id", "__hash").alias("h"))))
        rest = may_hold(rest.withColumn("h", F.xxhash64("__id", "__hash")), seen, "stays").where("stays").drop("h", "stays")
    there = gone.select(F.col("__id").alias("id"), F.col("__hash").alias("hash"))
    rest = rest.join(there, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__hash") == F.col("hash")), "left_anti")
    return clear.unionByName(rest.select("row.*"))


def kept_only(docs: DataFrame, decided: DataFrame, hashed: Column, scratch: Scratch) -> DataFrame:
    """``docs`` without the rows that ``decided`` does not keep: (__id, __hash, kept) of every row, alike for equal rows."""
    decided = scratch.stage(decided.select("__id", "__hash", "kept"))
    return without(docs, decided.where("not kept"), hashed, scratch, decided.where("kept is not false"))


def bounded_sample(rows: DataFrame, total: int, n: int) -> DataFrame:
    """The about ``n`` rows of smallest hash ``h`` of ``total``, at most ``n``.

    A threshold on the hash leaves a little more than ``n`` rows in all tasks together before they are sorted,
    so what meets in one task does not grow with the input.
    """
    place = F.shiftrightunsigned("h", 11)
    share = min(1.0, (1.3 * n + 200) / max(total, 1))
    return rows.where(place < int(share * 2**53) + 1).orderBy(place, "h").limit(n)


def dense_rank(df: DataFrame, order_by: Sequence[str], name: str, scratch: Scratch, partitions: int | None = None) -> DataFrame:
    """Add 0..n-1 in the order of ``order_by`` (NULL first) without one task seeing all rows.

    Rows are range-partitioned, numbered in their range, staged, and shifted by the sizes of the ranges
    before; only those sizes (one row per range) are broadcast. ``order_by`` should end in columns that tell
    rows apart, else a group of equal rows stays in one range.
    """
    order = [F.col(c) for c in order_by]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).select("*", F.monotonically_increasing_id().alias("__at"))
    rows = scratch.stage(placed)
    bits = 33  # monotonically_increasing_id keeps the partition number above
    part = F.shiftright("__at", bits).alias("__part")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part).count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__off"))
    at = F.col("__at") - F.shiftleft(F.col("__part"), bits) + F.col("__off")
    return rows.withColumn("__part", part).join(F.broadcast(sizes), "__part").withColumn(name, at).drop("__at", "__part", "__off")


def _signature(edges: DataFrame) -> tuple:
    """One row that changes whenever the set of edges does."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def components(edges: DataFrame, scratch: Scratch, rounds: int = 40) -> DataFrame:
    """Connected components of undirected ``edges(a, b)`` of any ordered type: rows (node, root), root the smallest.

    Alternating large-star and small-star steps. Each step takes a minimum per node, combined before the
    shuffle, stages it and joins it back to the edges, so a node with very many edges is split like any
    skewed join key. Edges of every round are staged in the shared folder. Only two numbers per round reach the driver.
    """
    e = scratch.stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _signature(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large, used = scratch.stage(large), low
        low = scratch.stage(large.groupBy("a").agg(F.min("b").alias("m")))
        pairs = large.join(low, "a")
        small = pairs.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        new = scratch.stage(small)
        now = _signature(new)
        scratch.release(e, large, used, low)
        e = new
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
