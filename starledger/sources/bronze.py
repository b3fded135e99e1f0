"""Raw snapshots: records kept as they came, with when and where they came from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from starledger.sources.tables import swap_folder


def write_bronze(
    df: DataFrame, path: str, source: str, ingested_at: str, location_id: str | None = None
) -> DataFrame:
    """Put a snapshot of records into a folder and return its manifest, one row.

    Records go out one per line under ``record``, with their metadata beside it, so that no field of a record
    meets a field of the snapshot; a frame of just a ``record`` column is taken as it is. The partition is
    named after the snapshot: one of any size is written and read by many tasks, and a snapshot that is
    delivered again replaces itself. ``record_count`` is observed while writing, in the same pass.
    """
    seen = Observation()
    records = df if df.columns == ["record"] else df.select(F.struct("*").alias("record"))
    stamped = records.withColumns({"source": F.lit(source), "location_id": F.lit(location_id).cast("string")})
    (
        stamped.observe(seen, F.count(F.lit(1)).alias("record_count"))
        .withColumn("ingested_at", F.lit(ingested_at))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingested_at")
        .json(path)
    )
    row = (ingested_at, source, location_id, seen.get["record_count"])
    schema = "ingested_at string, source string, location_id string, record_count bigint"
    return df.sparkSession.createDataFrame([row], schema)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All snapshots of a folder. Each repeats the whole entity; see ``latest_per_key`` for the newest."""
    metadata = T.StructType.fromDDL("source string, location_id string, ingested_at string")
    return spark.read.schema(T.StructType(schema.fields + metadata.fields)).json(path)


def write_fixed(df: DataFrame, path: str) -> None:
    """Replace the one snapshot kept in a folder. The old one stays whole until the new one is complete."""
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}.new"
    df.write.json(beside)
    swap_folder(df.sparkSession, beside, path)


def inventory_request_keys(catalog: DataFrame) -> DataFrame:
    """The variations of a catalog to ask stock for: id, item id and stock-keeping unit."""
    return catalog.filter((F.col("record.type") == "ITEM_VARIATION") & (F.col("record.id") != "")).select(
        F.col("record.id").alias("catalog_object_id"),
        F.col("record.item_variation_data.item_id").alias("item_id"),
        F.col("record.item_variation_data.sku").alias("sku"),
    )


def request_key_counts(keys: DataFrame) -> DataFrame:
    """One row: variations to ask for and how many of their ids are unique."""
    return keys.agg(
        F.count("*").alias("total_variations"), F.count_distinct("catalog_object_id").alias("unique_variations")
    )
