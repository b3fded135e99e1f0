"""Table sinks. Tables are parquet; writes replace the whole table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from starledger.sources.readers import scan_table, stored_bounds


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def swap_folder(spark: SparkSession, new: str, name: str) -> None:
    """Put the complete folder ``new`` in the place of ``name``; the old one comes back if that fails."""
    files, at = _files(spark, new)
    _, to = _files(spark, name)
    _, old = _files(spark, f"{name.rstrip('/')}-{uuid.uuid4().hex}.old")
    there = files.exists(to)
    if there and not files.rename(to, old):
        raise OSError(f"{name} cannot be moved away")
    try:
        if not files.rename(at, to):
            raise OSError(f"{name} cannot be put in place")
    except Exception:
        if there:
            files.rename(old, to)
        raise
    files.delete(old, True)


def swap_table(spark: SparkSession, new: str, name: str) -> None:
    """Give the complete catalog table ``new`` the name ``name``; the old one gets its name back if that fails."""
    old = f"{name}_{uuid.uuid4().hex}_old"
    there = spark.catalog.tableExists(name)
    if there:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    except Exception:
        if there:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    if there:
        spark.sql(f"DROP TABLE {old}")


def _save(df: DataFrame, name: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> None:
    """A table is written beside the old one and takes its place when it is complete; a failing write leaves the old one."""
    spark = df.sparkSession
    if partition_by:
        # One writer per value, and more where adaptive execution splits a hot one.
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.partitionBy(*partition_by)
    if "/" not in name:
        beside = f"{name}_{uuid.uuid4().hex}_new"
        try:
            writer.format("parquet").saveAsTable(beside)
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {beside}")
            raise
        swap_table(spark, beside, name)
        return
    beside = f"{name.rstrip('/')}-{uuid.uuid4().hex}.new"
    writer.parquet(beside)
    swap_folder(spark, beside, name)


def _exists(spark: SparkSession, name: str) -> bool:
    if "/" not in name:
        return spark.catalog.tableExists(name)
    files, at = _files(spark, name)
    return files.exists(at)


def write_table(
    df: DataFrame, name: str, evolve_schema: bool = True, skip_empty: bool = False, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> bool:
    """Replace a table (a catalog name, or a path where ``name`` holds a slash). True when it was written.

    A table is written beside the old one, which stays whole until the new one is complete and then takes its name;
    between the two renames there is a moment without a table.
    ``partition_by`` makes a folder per value of the columns, with few files each; ``sort_by`` sorts the rows of
    each file, so that readers skip row groups by the least and greatest values in it.

    With ``evolve_schema`` the new rows bring their own schema; without it they must have that of the table.
    ``skip_empty`` leaves the table as it is when there are no rows.
    """
    if skip_empty and df.isEmpty():
        return False
    if not evolve_schema and _exists(df.sparkSession, name):
        old = [(f.name, f.dataType) for f in scan_table(df.sparkSession, name).schema.fields]
        new = [(f.name, f.dataType) for f in df.schema.fields]
        if old != new:
            raise ValueError(f"{name} has another schema: {old} is not {new}")
    _save(df, name, partition_by, sort_by)
    return True


def verify_write(spark: SparkSession, name: str) -> DataFrame:
    """Re-read a table and count its rows, as one row. A table at a path answers from its file footers."""
    if "/" in name:
        return stored_bounds(spark, name)
    return scan_table(spark, name).agg(F.count("*").alias("row_count"))
