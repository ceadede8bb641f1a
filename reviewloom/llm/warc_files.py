"""Deterministic sharded WARC writer and its reader.

Records are dealt to shards by key range: payload bytes are summed over at most
``BINS`` equal key ranges, and neighbouring ranges are joined until a shard is full;
a range that is too large for one shard (a key that many rows share) is split further
by a content hash. The boundaries follow from the data alone, so two runs write the
same files. Inside a shard records are sorted by key, and files roll when their
compressed size passes ``file_bytes``. Headers and digests are made anew from the
payload, and every record is a gzip member of its own.

Files are written under temporary names in the shared folder. Each task reports what
it closed; the reports make the manifest, and a second job gives the files of the
manifest their final names, so files of lost or repeated attempts are never part of
an archive. A renamed file that is met again is left alone, so the job can be rerun.

Of records with equal payloads of at least ``revisit_bytes`` bytes the one with the
smallest key is a response and the others revisit it. That, and the shards, come from
narrow rows (key, address, digest, size); a payload crosses the network once, to its
shard, where the verdicts on repeated payloads are sorted in before it.

Defined cases: keys are whole numbers; a null payload is an empty one; a null key is written without a key
header, sorts first and is read back as null; rows that repeat key and payload are
each written (one response, the others revisit its key); an empty table makes an
empty archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reviewloom.session import Workspace

BINS = 65_536
SHARD_BYTES, FILE_BYTES = 256 << 20, 64 << 20
DATE = "2000-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
_MANIFEST = "shard bigint, number int, temporary string, final string, records bigint, bytes bigint, sha256 string"


def open_folder(url: str):
    """(file system, path) of a folder; the URL's scheme says where it is."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(url if ":/" in url else f"file://{url}")


# --- records ---------------------------------------------------------------------

def record_id(key, digest: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{key}/{digest}/{number}')}>"


def http_head(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def build_record(key, uri: str | None, payload: bytes, digest: str, refers_to, number: int) -> bytes:
    """One record; ``refers_to`` (the key of a response) makes it a revisit."""
    revisit = refers_to is not None
    block = http_head(len(payload)) + (b"" if revisit else payload)
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key, digest, number)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_one_line(uri)}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if key is not None:
        lines.append(f"X-Record-Key: {key}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest, 0)}", f"X-Refers-To-Key: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(uri: str | None) -> str:
    return "".join(c if c.isprintable() and c != " " else "%%%02X" % ord(c) for c in uri or "")


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a gzipped archive, as a stream; lengths and digests are checked."""
    def members() -> Iterator[bytes]:
        rest, done = b"", False
        while not done or rest:
            inflate, parts = zlib.decompressobj(31), []
            while not inflate.eof:
                if not rest:
                    rest = source.read(1 << 20)
                    if not rest:
                        if parts:
                            raise ValueError("an archive ends inside a record")
                        return
                parts.append(inflate.decompress(rest))
                rest = inflate.unused_data if inflate.eof else b""
            yield b"".join(parts)

    for record in members():
        head, _, body = record.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        block = body[: int(headers["Content-Length"])]
        if not first.startswith("WARC/") or body[len(block) :] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
            raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
        yield headers, block


# --- writing ---------------------------------------------------------------------

def _revisited(narrow: DataFrame, revisit_bytes: int) -> DataFrame:
    """(shard, key, digest, first) of the rows whose payload occurs more than once; ``first`` is its smallest key."""
    groups = (
        narrow.where(F.col("size") >= revisit_bytes).groupBy("digest")
        .agg(F.count("*").alias("n"), F.min("key").alias("first")).where("n > 1 and first is not null")
    )
    return narrow.join(groups.select("digest", "first"), "digest").select("shard", "key", "digest", "first").distinct()


def _bin(low: int, high: int) -> F.Column:
    """Number of the key range of a row, -1 without a key; at most BINS ranges."""
    width = max(1, -(-(int(high) - int(low) + 1) // BINS))
    return F.coalesce(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(-1)).cast("bigint")


def _shard_plan(narrow: DataFrame, shard_bytes: int) -> DataFrame:
    """(bin, parts, first_shard) from the byte sums of key ranges: at most BINS + 1 rows.

    Sums of what comes before a range are taken in two levels, over ranges of 256 bins and inside each.
    """
    bins = narrow.groupBy("bin").agg(F.sum(F.col("size") + 600).alias("bytes")).withColumn("parts", F.ceil(F.col("bytes") / F.lit(shard_bytes)).cast("bigint"))
    bins = bins.withColumn("range", F.floor(F.col("bin") / 256))
    ranges = bins.groupBy("range").agg(F.sum("bytes").alias("b"), F.sum(F.col("parts") - 1).alias("p"))
    every = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.select("range", F.coalesce(F.sum("b").over(every), F.lit(0)).alias("b"), F.coalesce(F.sum("p").over(every), F.lit(0)).alias("p"))
    inside = Window.partitionBy("range").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c, own: F.coalesce(F.sum(own).over(inside), F.lit(0)) + F.col(c)
    placed = bins.join(before, "range")
    return placed.select("bin", "parts", (F.floor(earlier("b", "bytes") / F.lit(shard_bytes)) + earlier("p", F.col("parts") - 1)).alias("first_shard"))


def _with_shard(rows: DataFrame, plan: DataFrame) -> DataFrame:
    part = F.pmod(F.xxhash64("digest", "uri", "key"), F.col("parts"))
    return rows.join(F.broadcast(plan), "bin").withColumn("shard", (F.col("first_shard") + part).cast("bigint")).drop("bin", "parts", "first_shard")


def write_archive(
    pages: DataFrame, folder: str, *, key_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", revisit_bytes: int = 100,
    shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, level: int = 6,
) -> DataFrame:
    """Write all rows under ``folder`` and return the manifest (one row per file)."""
    spark = pages.sparkSession
    space = Workspace(spark, "warc-plan")
    payload = F.coalesce(pages[payload_col].cast("binary"), F.lit(b""))
    rows = pages.select(pages[key_col].alias("key"), pages[uri_col].cast("string").alias("uri"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("bigint").alias("size"))
    # what is decided from all records is decided on narrow rows; payloads move once, to their shard, and the verdicts meet them there
    narrow = space.write(rows.drop("payload"), "narrow")
    span = narrow.agg(F.min("key").alias("a"), F.max("key").alias("b")).first()
    number = _bin(*((span["a"], span["b"]) if span["a"] is not None else (0, 0)))
    plan = space.write(_shard_plan(narrow.withColumn("bin", number), shard_bytes), "plan")
    verdicts = _revisited(_with_shard(narrow.withColumn("bin", number), plan), revisit_bytes)
    records = _with_shard(rows.withColumn("bin", number), plan).select("shard", "key", "uri", "payload", "digest", F.lit(None).cast(pages.schema[key_col].dataType).alias("first"))
    both = records.unionByName(verdicts.withColumn("uri", F.lit(None).cast("string")).withColumn("payload", F.lit(None).cast("binary")))
    # a verdict stands before the records of its key and payload
    dealt = both.repartition("shard").sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "digest", F.col("payload").isNotNull(), "uri")
    root = f"{folder.rstrip('/')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(root)
        system.create_dir(path, recursive=True)
        attempt, out, done = uuid.uuid4().hex, None, []
        shard, number, last, repeat, verdict = None, 0, None, 0, None

        def close() -> None:
            nonlocal out
            if out is not None:
                stream, name, count, size, digest, s, k = out
                stream.close()
                done.append((s, k, name, f"part-{s:08d}-{k:05d}.warc.gz", count, size, digest.hexdigest()))
                out = None

        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    close()
                    shard, number, last, repeat, verdict = r["shard"], 0, None, 0, None
                if r["payload"] is None:
                    verdict = (r["key"], r["digest"], r["first"])
                    continue
                if out is None:
                    name = f".part-{shard:08d}-{number:05d}-{attempt}.tmp"
                    out = [system.open_output_stream(f"{path}/{name}", compression=None), name, 0, 0, hashlib.sha256(), shard, number]
                    number += 1
                same = (r["key"], r["digest"])
                repeat = repeat + 1 if same == last else 0
                last = same
                first = verdict[2] if verdict is not None and verdict[:2] == same else None
                # rows that repeat the smallest key: one of them stays a response
                refers = first if first is not None and (r["key"] != first or repeat) else None
                record = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = record.compress(build_record(r["key"], r["uri"], r["payload"], r["digest"], refers, repeat)) + record.flush()
                out[0].write(data)
                out[2] += 1
                out[3] += len(data)
                out[4].update(data)
                if out[3] >= file_bytes:
                    close()
        close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["shard", "number", "temporary", "final", "records", "bytes", "sha256"])

    spark_manifest = dealt.mapInArrow(run, _MANIFEST)
    spark_manifest.write.mode("overwrite").parquet(f"{root}/_manifest")
    manifest = spark.read.schema(_MANIFEST).parquet(f"{root}/_manifest")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, path = open_folder(root)
        for batch in batches:
            for r in batch.to_pylist():
                if system.get_file_info(f"{path}/{r['temporary']}").type != fs.FileType.NotFound:
                    system.move(f"{path}/{r['temporary']}", f"{path}/{r['final']}")
            yield batch

    manifest.mapInArrow(commit, _MANIFEST).write.mode("overwrite").parquet(f"{root}/_committed")
    space.close()
    _forget_attempts(root)
    return spark.read.schema(_MANIFEST).parquet(f"{root}/_committed")


def _forget_attempts(root: str) -> None:
    """Delete the temporary files that lost or repeated attempts have left behind."""
    from pyarrow import fs

    system, path = open_folder(root)
    if system.get_file_info(path).type == fs.FileType.Directory:
        for info in system.get_file_info(fs.FileSelector(path)):
            if info.base_name.startswith(".part-") and info.base_name.endswith(".tmp"):
                system.delete_file(info.path)


# --- reading ---------------------------------------------------------------------

def read_archive(manifest: DataFrame, folder: str, key_type: T.DataType = T.LongType()) -> DataFrame:
    """Rows (key, uri, payload, payload_bytes, payload_digest, record_type, refers_to) of the files of a manifest; a revisit has no payload of its own."""
    kind = T.StructType([
        T.StructField("key", T.StringType()), T.StructField("uri", T.StringType()), T.StructField("payload", T.BinaryType()), T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as source:
                    for h, block in read_records(source):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                        digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                        if h["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"damaged payload {h['WARC-Record-ID']}")
                        rows.append((h.get("X-Record-Key"), h["WARC-Target-URI"], payload, length, digest, h["WARC-Type"], h.get("X-Refers-To-Key")))
                        size += len(payload)
                        if size > 8 << 20:
                            yield _batch(rows, kind)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, kind)

    total = manifest.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    # a number of its own, since small partitions would be put together again
    parts = max(1, min(total["files"], max(2 * manifest.sparkSession.sparkContext.defaultParallelism, total["bytes"] // (32 << 20) + 1)))
    out = manifest.select("final").repartition(parts, "final")
    out = out.mapInArrow(run, kind)
    return out.withColumn("key", F.col("key").cast(key_type)).withColumn("refers_to", F.col("refers_to").cast(key_type))


def _batch(rows: list[tuple], kind: T.StructType) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=kind.names)


def archive_folder(spark: SparkSession, name: str = "warc") -> str:
    """A new folder in the shared folder."""
    return Workspace(spark, name).path("files")
