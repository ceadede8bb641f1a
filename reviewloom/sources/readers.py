"""Reading record files, table snapshots, saved pages and landed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom import schemas
from reviewloom.operators.dedup import unify
from reviewloom.sources.json_array import read_array


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """True when the path or glob names at least one file on its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_records(spark: SparkSession, path: str, schema: str = schemas.PRICING_RECORD, lines: bool = False, split: bool = False) -> DataFrame:
    """JSON array files (or JSON Lines) as records; a missing path is an empty frame.

    One JSON array is read by one task, or with ``split`` by many, which reads large
    files twice.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    if split and not lines:
        return read_array(spark, path, schema)
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def newest_file(spark: SparkSession, pattern: str, schema: str, lines: bool = False) -> DataFrame:
    """Records of the last file of a glob in name order.

    The name is decided from file listing metadata, so older files are not scanned.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    names = sorted(status.getPath().toString() for status in found)
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", not lines).json(names[-1])


def newest_batch(df: DataFrame, order: str = "file_path") -> DataFrame:
    """Rows whose order value (file path, run time) is the largest in the frame."""
    top = df.agg(F.max(order)).scalar()
    return df.filter(F.col(order) == top)


def with_file_path(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("file_path"))


def read_package_files(
    spark: SparkSession, packages: str, direct: str, websites: str, lines: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three package sources in one shape each, with ``seq`` as reading order.

    Files are read in name order; the website source is an object keyed by vendor
    name. A file is one JSON document, or with ``lines`` one document per line,
    which lets Spark split large files.
    """
    first = read_elements(spark, packages, schemas.PACKAGE_FILE, lines)
    found = F.when(F.size("prices_found") > 0, F.col("prices_found")).otherwise(F.col("starting_prices_raw"))
    first = first.select(
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("packages", F.array()).alias("packages"),
        F.coalesce(found, F.array()).alias("prices_found"),
        "seq",
    )
    probe = read_elements(spark, direct, schemas.DIRECT_PACKAGE_FILE, lines).select(
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("packages", F.array()).alias("packages"),
        F.coalesce("prices_clean", F.array()).alias("prices_clean"),
        F.coalesce("prices", F.array()).alias("prices"),
        F.coalesce("phone", F.lit("")).alias("phone"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("pages_ok", F.lit(0)).alias("pages_ok"),
        F.coalesce("url", F.lit("")).alias("website_url"),
        "seq",
    )
    if path_exists(spark, websites):
        entries = F.from_json("value", f"MAP<STRING, {schemas.WEBSITE_ENTRY}>")
        sites = _documents(spark, websites, lines).select("_file", "_line", F.posexplode(entries).alias("_pos", "name", "v"))
        sites = sites.select("name", "v.phone", "v.website_url", F.struct("_file", "_line", "_pos").alias("seq"))
    else:
        sites = spark.createDataFrame([], f"name STRING, phone STRING, website_url STRING, seq {_SEQ_TYPE}")
    return first, probe, sites


_SEQ_TYPE = "STRUCT<_file: STRING, _line: BIGINT, _pos: INT>"


def _documents(spark: SparkSession, pattern: str, lines: bool) -> DataFrame:
    """JSON documents with their file and, for line files, a number that grows along the file."""
    raw = spark.read.text(pattern, wholetext=not lines)
    return raw.select("value", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line"))


def read_elements(spark: SparkSession, pattern: str, element: str, lines: bool = False) -> DataFrame:
    """Elements of JSON arrays with their reading order."""
    if not path_exists(spark, pattern):
        return spark.createDataFrame([], f"{element}, seq {_SEQ_TYPE}")
    elements = F.from_json("value", f"ARRAY<STRUCT<{_fields(element)}>>")
    rows = _documents(spark, pattern, lines).select("_file", "_line", F.posexplode(elements).alias("_pos", "e"))
    return rows.select("e.*", F.struct("_file", "_line", "_pos").alias("seq"))


def _fields(ddl: str) -> str:
    """Table DDL to struct DDL with the same fields."""
    import pyspark.sql.types as T

    return T.StructType.fromDDL(ddl).simpleString()[len("struct<"):-1]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table snapshot; columns and filters are pushed into the scan."""
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A database table in key ranges, so the read is spread over tasks."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=str(low), upperBound=str(high),
                 numPartitions=str(parts), **options)
        .load()
    )


def read_saved_pages(spark: SparkSession, pattern: str, below: bool = False) -> DataFrame:
    """Saved HTML files, one row per file; ``below`` reads all folders below the named one as well."""
    return _whole_files(spark, pattern, below).select(F.col("file_path").alias("path"), F.col("value").alias("html"))


def read_payloads(spark: SparkSession, pattern: str, below: bool = False) -> DataFrame:
    """Landed payload files, one JSON document per file, kept as text for the parsers; ``below`` as for saved pages."""
    return _whole_files(spark, pattern, below).select(F.col("file_path").alias("path"), F.col("value").alias("payload"))


def _whole_files(spark: SparkSession, pattern: str, below: bool) -> DataFrame:
    """Many folders are better named by the one above them: it is listed once, by tasks, where a glob makes each an input of its own."""
    return with_file_path(spark.read.option("recursiveFileLookup", below).text(pattern, wholetext=True))


def read_payload_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """Landed payloads with one JSON document per line; splittable, use this for large drops."""
    return spark.read.text(pattern).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload")
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    return unify(list(frames))
