"""Readers. Each returns a lazy frame under a given schema, or under one found in a pass over the files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def _with_bad(schema: T.StructType | str, bad: str | None) -> tuple[T.StructType, dict]:
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if bad is None:
        return schema, {}
    return T.StructType(schema.fields + [T.StructField(bad, T.StringType())]), {"columnNameOfCorruptRecord": bad}


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str, bad: str | None = None) -> DataFrame:
    """A folder of JSON files that hold one object, or one array of objects, over many lines.

    Such a file is read by one task. Keep files small; large snapshots belong in line-delimited files, see
    :func:`scan_json_lines`. Text that cannot be read goes to the column ``bad`` where one is named.
    """
    schema, options = _with_bad(schema, bad)
    return spark.read.schema(schema).options(multiLine=True, **options).json(path)


def scan_json_lines(spark: SparkSession, path: str, schema: T.StructType | str, bad: str | None = None) -> DataFrame:
    """A folder of line-delimited JSON, which Spark splits over tasks; see :func:`scan_json` for ``bad``."""
    schema, options = _with_bad(schema, bad)
    return spark.read.schema(schema).options(**options).json(path)


def bad_records(df: DataFrame, bad: str) -> DataFrame:
    """One row: records read, and how many of them could not be read."""
    # Spark refuses to read the column of bad text alone, so another one is read with it.
    seen = df.select(F.struct("*").alias("r"))
    return seen.agg(F.count("*").alias("records"), F.count(F.when(F.col("r")[bad].isNotNull(), F.col("r"))).alias("bad_records"))


def scan_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Line-delimited JSON under the schema found in it.

    Finding the schema is one distributed pass; the frame then keeps that schema whatever is added later.
    """
    return scan_json_lines(spark, path, spark.read.json(path).schema)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV in UTF-8 with a header line; every column is text unless a schema says otherwise."""
    reader = spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A saved table, or a parquet folder where ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def source_files(spark: SparkSession, path: str, df: DataFrame | None = None) -> DataFrame:
    """All files of a folder, also those without rows, from their metadata: file_path, length, modified.

    Spark's index lists the folders, in tasks where there are many, and the rows are made in tasks from it; no file
    is opened, and the driver's Python sees none. Hidden files and files of no bytes are left out. With ``df``, the frame that reads the
    folder, ``row_count`` holds the rows of each file.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = listed.select(F.col("path").alias("file_path"), "length", F.col("modificationTime").alias("modified"))
    if df is None:
        return files
    rows = df.groupBy(F.col("_metadata.file_path").alias("__path")).agg(F.count("*").alias("row_count"))
    same = F.regexp_replace("file_path", "^file:/+", "/") == F.regexp_replace("__path", "^file:/+", "/")
    return files.join(rows, same, "left").select("file_path", "length", "modified", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def typed_rows(df: DataFrame, column: str, schema: T.StructType | str, bad: str | None = None) -> DataFrame:
    """JSON text, one record per row, to columns of a given schema.

    Text that cannot be read under it gives a row of NULLs; the column ``bad``, where one is named, then holds the text.
    """
    schema, options = _with_bad(schema, bad)
    return df.select(F.from_json(column, schema, options).alias("record")).select("record.*")


# -- schemas found in files ------------------------------------------------------------------------

_TEXT, _FILE = "value", "__file"


def _documents(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """The JSON texts of a folder, one row per line, or per file where a document has many lines."""
    read = spark.read.option("wholetext", multi_line).option("recursiveFileLookup", True).text(path)
    texts = read.select(F.col(_TEXT), F.col("_metadata.file_path").alias(_FILE)).filter(F.trim(_TEXT) != "")
    return texts.withColumn("parsed", F.try_parse_json(_TEXT))


def widened(found: str | None) -> T.StructType:
    """The schema to read under, of one that ``schema_of_variant_agg`` found in all records together.

    Rules: whole numbers are long; whole numbers and fractions together are double; a field that is always NULL, is an
    object without fields, or has values of kinds that do not widen into each other (a number here, text or an object there)
    is string, which keeps the text of each value. A field that some files lack is NULL there. Arrays widen their
    elements, objects their fields, by the same rules.
    """
    if found is None:
        return T.StructType()
    ddl = re.sub(r"(?<=[:<] )(VARIANT|VOID|OBJECT<>)|(?<=<)(VARIANT|VOID|OBJECT<>)(?=>)", "STRING", found)
    ddl = re.sub(r"(?<=[:<] )(DECIMAL\(\d+,\d+\)|FLOAT)|(?<=<)(DECIMAL\(\d+,\d+\)|FLOAT)(?=>)", "DOUBLE", ddl)
    kind = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", ddl))
    kind = kind.elementType if isinstance(kind, T.ArrayType) else kind
    if not isinstance(kind, T.StructType):
        raise ValueError(f"the files do not hold objects: {found}")
    return kind


def merged_schema(spark: SparkSession, path: str, multi_line: bool = False) -> T.StructType:
    """One schema for all JSON files of a folder, whatever fields and kinds each of them has.

    One aggregation over the parsed records: every task merges the kinds it sees, and only the merged type
    reaches the driver. See :func:`widened` for the rules. Text that is not JSON does not count.
    """
    found = _documents(spark, path, multi_line).agg(F.schema_of_variant_agg("parsed").alias("s")).first()["s"]
    return widened(None if found == "VOID" else found)


def file_schemas(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """What each file holds by itself: file_path, found (its merged type), records and bad_records."""
    return _documents(spark, path, multi_line).groupBy(F.col(_FILE).alias("file_path")).agg(
        F.schema_of_variant_agg("parsed").alias("found"), F.count("*").alias("records"), F.count_if(F.col("parsed").isNull()).alias("bad_records")
    )


def scan_json_merged(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A folder of JSON, with the folders in it, under the schema merged over its files.

    The frame keeps that schema whatever is added later.
    """
    schema = merged_schema(spark, path, multi_line)
    return spark.read.schema(schema).options(multiLine=multi_line, recursiveFileLookup=True).json(path)


# -- answers from file footers ----------------------------------------------------------------------

_READERS, _PUSHED = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def scan_footers(spark: SparkSession, path: str) -> DataFrame:
    """A parquet folder through the reader that answers counts, minima and maxima from file footers.

    ``count``, and ``min`` and ``max`` of whole columns of numbers, booleans and dates, without filters on other than folder
    columns, then read no row groups. Anything else works as in :func:`scan_table`, but plans no dynamic
    pruning. The setting that lets aggregates reach this reader stays on in the session; other readers ignore it.
    """
    before = spark.conf.get(_READERS)
    spark.conf.set(_PUSHED, "true")
    spark.conf.set(_READERS, ",".join(f for f in before.split(",") if f.strip() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(_READERS, before)


def stored_bounds(spark: SparkSession, path: str, columns: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """One row from the footers of a stored table: row_count, and min and max of each of ``columns`` (NULLs do not count).

    ``where`` is a condition on folder columns alone. A row group in which a column is always NULL has no bounds in its
    footer, and the reader refuses it: leave folders without values out by ``where``.
    """
    stored = scan_footers(spark, path)
    bounds = [f(c).alias(f"{kind}_{c}") for c in columns for kind, f in (("min", F.min), ("max", F.max))]
    return (stored if where is None else stored.filter(where)).agg(F.count("*").alias("row_count"), *bounds)


def empty_rows(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows under a given schema."""
    return spark.createDataFrame([], schema)
