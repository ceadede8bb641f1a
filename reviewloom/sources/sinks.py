"""Writing record files, CSV reports, table versions and the dashboard document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom import schemas
from reviewloom.operators.packages import child_rows, vendor_summary
from reviewloom.operators.upsert import INSERT_ONLY, OVERWRITE, upsert
from reviewloom.session import spread


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Records as JSON Lines, one file per task."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_latest_and_archive(df: DataFrame, root: str, run_ts: str) -> str:
    """Write one archive partition; ``latest`` is the newest partition, so data is written once."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{root}/run_ts={run_ts}")
    return f"{root}/run_ts={run_ts}"


def finished(spark: SparkSession, root: str, partition: str) -> list[str]:
    """Sorted ``partition=value`` folders whose write was committed; half-written ones are not seen."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{partition}=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(status.getPath().getParent().toString() for status in found)


def read_latest(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The newest finished archive partition; the others stay unread."""
    folders = finished(spark, root, "run_ts")
    return spark.read.schema(schema).json(folders[-1]) if folders else spark.createDataFrame([], schema)


def write_files(df: DataFrame, path: str, text: str, key: str, folders: bool = True) -> None:
    """A text file per row, below a folder ``key=value`` of its own or all in one folder, which is listed faster.

    The cost is that of the files, not of the bytes: the rows are dealt over all tasks, however
    small they are, and every task moves its own files in place (not the driver at the end).
    """
    rows = spread(df.select(F.col(text).alias("value"), key), key)
    rows = rows if folders else rows.drop(key)
    writer = rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    (writer.partitionBy(key) if folders else writer.option("maxRecordsPerFile", 1)).text(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_pricing_csv(df: DataFrame, path: str) -> None:
    write_csv(df, path, schemas.PRICING_CSV_COLUMNS)


def write_vendor_summary_csv(vendors: DataFrame, path: str, columns: Sequence[str]) -> None:
    write_csv(vendor_summary(vendors, columns), path)


def write_package_csv(vendors: DataFrame, path: str, parents: Sequence[str] = ("business_name", "url")) -> None:
    write_csv(child_rows(vendors, parents), path)


def section_rows(sections: Mapping[str, DataFrame]) -> DataFrame:
    """(name, place, record) rows of section frames, and one row without a record for each section.

    Rows keep the order of ``_place`` where a frame has that column, else their own.
    """
    from reviewloom.operators.dedup import unify

    rows = []
    for name, df in sections.items():
        place = F.col("_place") if "_place" in df.columns else F.struct(F.monotonically_increasing_id().alias("n0"))
        record = F.to_json(F.struct(*[c for c in df.columns if c != "_place"]), {"ignoreNullFields": "false"})
        rows.append(df.select(F.lit(name).alias("name"), place.alias("place"), record.alias("record")))
    names = rows[0].sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in sections])).alias("name"))
    return unify([*rows, names])


def document_of(rows: DataFrame, single: Sequence[str] = ()) -> DataFrame:
    """One JSON object from section rows. Names in ``single`` become objects, the others become lists."""
    kept = F.array_sort(F.collect_list(F.when(F.col("record").isNotNull(), F.struct("place", "record"))))
    records = F.transform(kept, lambda r: r["record"])
    listed = F.concat(F.lit("["), F.array_join(records, ","), F.lit("]"))
    body = F.when(F.col("name").isin(*single), F.coalesce(F.try_element_at(records, F.lit(1)), F.lit("null"))).otherwise(listed) if single else listed
    bodies = rows.groupBy("name").agg(body.alias("body"))
    members = F.array_sort(F.collect_list(F.concat(F.lit('"'), F.col("name"), F.lit('":'), F.col("body"))))
    return bodies.agg(F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")).alias("value"))


def dashboard_document(sections: Mapping[str, DataFrame], single: Sequence[str] = ()) -> DataFrame:
    """One JSON object from small aggregated frames: groups, top lists, single rows, never detail rows."""
    return document_of(section_rows(sections), single)


def write_document(document: DataFrame, path: str) -> None:
    document.coalesce(1).write.mode("overwrite").text(path)


def write_version(df: DataFrame, root: str, version: str, partition_by: Sequence[str] = ()) -> str:
    """New version directory of a table. Names must sort by age.

    Readers take the newest finished version, so a failed write is never visible and
    readers of the previous version are not disturbed.
    """
    path = f"{root}/version={version}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The newest finished version of a table."""
    folders = finished(spark, root, "version")
    if not folders:
        raise FileNotFoundError(f"no finished version below {root}")
    return spark.read.parquet(folders[-1])


def write_bucketed(df: DataFrame, table: str, key: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Bucketed table on the upsert key: later upserts and joins on it skip one shuffle."""
    writer = df.write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


# ---- run audit ------------------------------------------------------------

def start_run(spark: SparkSession, run_id: int, source: str, category: str, city: str = "", state: str = "",
              started_at: datetime | None = None) -> DataFrame:
    """Row to append to the runs table when a run begins."""
    row = (run_id, source, category, city, state, started_at or datetime.now(), None, None, None, "running", None)
    return spark.createDataFrame([row], schemas.RUNS)


RUN_POLICY = {
    "completed_at": OVERWRITE, "vendors_found": OVERWRITE, "vendors_successful": OVERWRITE, "status": OVERWRITE,
    "notes": OVERWRITE, "source": INSERT_ONLY,
}


def finish_runs(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Runs table with finished runs completed; counts are those of the run itself."""
    done = results.select(
        "id", "completed_at", F.col("vendors_found").cast("int").alias("vendors_found"),
        F.col("vendors_successful").cast("int").alias("vendors_successful"), F.lit("completed").alias("status"),
        F.coalesce("notes", F.lit("")).alias("notes"), F.col("completed_at").alias("_seq"),
    )
    known = done.join(runs.select("id"), "id", "left_semi")
    return upsert(runs, known, ["id"], RUN_POLICY, seq="_seq")


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc_nulls_first(), F.col("id").desc()).limit(n)
