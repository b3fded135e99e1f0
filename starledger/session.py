"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and local benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starledger")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    A local session without the setting gets a temporary folder. A cluster without it is an error: a
    machine-local folder would be lost with its machine.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="starledger-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/starledger/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


_STAGED: list[str] = []


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what :func:`stage` wrote inside; for blocks that also store what they built of it."""
    first = len(_STAGED)
    try:
        yield
    finally:
        for path in _STAGED[first:]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        del _STAGED[first:]


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back; with ``partition_by`` in a folder per value of these columns.

    Readers scan only the columns they need, and a lost executor rereads files instead of recomputing
    the plan behind ``df``. Inside :func:`releasing` the files go once the block has stored its results.
    """
    path = scratch_path(df.sparkSession, label)
    _STAGED.append(path)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
