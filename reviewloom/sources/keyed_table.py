"""A Parquet table laid out by a hash of its key, changed in the touched parts only.

``pmod(xxhash64(key), buckets)`` is the partition column. A batch names the buckets its
keys fall into, at most ``buckets`` numbers, and only those partitions are read, joined
and written; Spark prunes the others by their folder names and dynamic partition
overwrite leaves their files alone. Choose ``buckets`` so that one holds about a GB: a
bucket is written by one task, and keys are unique, so no key can make one large.

A change is written beside the table first (``_pending``, which readers do not see) and
then moved in. A run that stops between the two leaves a complete copy behind, which the
next change moves in before its own work. Changes are repeatable: an upsert of the same
batch gives the same rows, and ``insert_new`` adds no key twice, so a batch that is run
again after a failure, or comes late, or overlaps another one, is stored once.

There is one writer at a time. Rows with a null in the key are kept and match nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators.dedup import first_by_key
from reviewloom.operators.upsert import upsert
from reviewloom.sources.readers import path_exists

BUCKET = "bucket"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets
        self.pending = f"{self.path}/_pending"

    # ---- reading ----------------------------------------------------------

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/{BUCKET}=*")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def read_for(self, keys: DataFrame) -> DataFrame:
        """The rows of the buckets that occur among the keys of a frame, with the bucket."""
        return self._part(self.touched(keys))

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of a frame's keys."""
        return sorted(r[0] for r in rows.select(self._bucket().alias(BUCKET)).distinct().collect())

    def _part(self, buckets: Sequence[int]) -> DataFrame:
        return self.spark.read.parquet(self.path).where(F.col(BUCKET).isin(*buckets))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    # ---- changing ---------------------------------------------------------

    def create(self, rows: DataFrame) -> None:
        """Write a new table; keys have to be unique."""
        self._write(rows, self.path, "overwrite")

    def merge(self, batch: DataFrame, policy: Mapping[str, str], seq: str, blank_as_null: bool = False) -> None:
        """Apply a batch in ``seq`` order, see ``upsert``; untouched buckets keep their files."""
        self.recover()
        stored = self.read_for(batch).drop(BUCKET)
        self._replace(upsert(stored, batch, self.key, policy, seq, blank_as_null))

    def insert_new(
        self, batch: DataFrame, order: Sequence[Column | str], change: Callable[[DataFrame], DataFrame] | None = None, files: int = 8
    ) -> None:
        """Append the rows whose key is unknown, the first of each key in the given order, changed by ``change``.

        Of the stored rows only the keys of touched buckets are read. ``change`` must
        keep the key. A bucket with more than ``files`` files is then written anew.
        """
        self.recover()
        # dealt by bucket and key: the join with the known keys then needs no other exchange of the rows
        rows = first_by_key(batch.withColumn(BUCKET, self._bucket()), [BUCKET, *self.key], order)
        if not self.exists():
            rows = rows.drop(BUCKET)
            self.create(change(rows) if change else rows)
            return
        buckets = self.touched(batch)
        known = self._part(buckets).select(BUCKET, *self.key)
        rows = rows.join(known, [BUCKET, *self.key], "left_anti").drop(BUCKET)
        self._write(change(rows) if change else rows, self.path, "append")
        self.compact(files, buckets)

    def compact(self, files: int = 8, buckets: Sequence[int] | None = None) -> list[int]:
        """Write buckets with more than ``files`` files anew, one file each; returns those buckets."""
        self.recover()
        crowded = [b for b, n in self.files().items() if n > files and (buckets is None or b in buckets)]
        if crowded:
            self._replace(self._part(crowded).drop(BUCKET))
        return crowded

    def files(self) -> dict[int, int]:
        """Number of files in each bucket, from the folder listing."""
        found: dict[int, int] = {}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BUCKET}=*/part-*")
        for status in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []:
            bucket = int(status.getPath().getParent().getName().split("=")[1])
            found[bucket] = found.get(bucket, 0) + 1
        return found

    def recover(self) -> None:
        """Finish a change that was written completely but not moved in, and forget one that was not."""
        if path_exists(self.spark, f"{self.pending}/_SUCCESS"):
            self._move_in()
        elif path_exists(self.spark, self.pending):
            self._delete(self.pending)

    def _write(self, rows: DataFrame, path: str, mode: str) -> None:
        laid = rows.withColumn(BUCKET, self._bucket()).repartition(BUCKET)
        laid.write.mode(mode).partitionBy(BUCKET).parquet(path)

    def _replace(self, rows: DataFrame) -> None:
        self._write(rows, self.pending, "overwrite")
        self._move_in()

    def _move_in(self) -> None:
        if path_exists(self.spark, f"{self.pending}/{BUCKET}=*"):
            rows = self.spark.read.parquet(self.pending)
            rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        self._delete(self.pending)

    def _delete(self, where: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
