import collections
import gzip
import hashlib
import io
import os

import pytest

from reviewloom.llm import warc_files as W

PAGES = [(5, "http://a/ b\n", "x" * 100), (3, None, "x" * 100), (3, None, "x" * 100), (4, "u", "x" * 99), (6, "u", "x" * 99), (7, "ü", None), (8, "v", ""), (None, "n", "x" * 100), (9, "w", "é\r\n\r\n" * 90),
         (10, "w", "é\r\n\r\n" * 90), (-4, "w", "WARC/1.1\r\n\r\n")] + [(100 + i, f"http://h/{i}", f"page {i} " * (i + 1)) for i in range(60)]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "z") for i, u, h in rows], "page_id bigint, url string, html string, digest string")


def want(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    seen, out = set(), collections.Counter()
    for i, _, h in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b, f = (h or "").encode(), first.get(h or "")
        again = len(b) >= 100 and f is not None and (i is None or i > f or (i, b) in seen)
        seen.add((i, b))
        out[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None] += 1
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 30, 3000, 700])
def test_round_trip(spark, tmp_path, shard_bytes):
    manifest = W.write_archive(pages(spark, PAGES), str(tmp_path / "a"), shard_bytes=shard_bytes, file_bytes=2000)
    out = W.read_archive(manifest, str(tmp_path / "a")).collect()
    assert collections.Counter((r["key"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out) == want(PAGES)
    for r in out:
        if r["record_type"] == "response":
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]


def test_two_runs_write_the_same_files(spark, tmp_path):
    for name, parts in (("a", 1), ("b", 5)):
        W.write_archive(pages(spark, PAGES).repartition(parts), str(tmp_path / name), shard_bytes=4000, file_bytes=1500)
    a, b = ({f: (tmp_path / n / f).read_bytes() for f in os.listdir(tmp_path / n) if f.endswith(".gz")} for n in "ab")
    assert a == b and len(a) > 3
    assert not [f for f in os.listdir(tmp_path / "a") if f.endswith(".tmp")]
    text = b"".join(gzip.decompress(x) for x in a.values())
    assert text.count(b"WARC/1.1\r\nWARC-Type") == len(PAGES)


def test_damage_is_noticed():
    record = gzip.compress(W.build_record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, 0))
    assert len(list(W.read_records(io.BytesIO(record * 2)))) == 2
    with pytest.raises(Exception):
        list(W.read_records(io.BytesIO(record + record[:-12])))
    bad = gzip.compress(gzip.decompress(record).replace(b"payload\r\n", b"pay1oad\r\n"))
    with pytest.raises(ValueError):
        list(W.read_records(io.BytesIO(bad)))


def test_empty_table(spark, tmp_path):
    assert W.read_archive(W.write_archive(pages(spark, []), str(tmp_path / "e")), str(tmp_path / "e")).count() == 0


def test_payloads_move_once_and_files_are_read_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    manifest = W.write_archive(pages(spark, PAGES), str(tmp_path / "a"), shard_bytes=3000, file_bytes=2000)
    read = W.read_archive(manifest, str(tmp_path / "a"))
    assert manifest.count() > 8 and read.select(F.spark_partition_id().alias("p")).distinct().count() > 2


def test_files_of_lost_attempts_are_deleted(spark, tmp_path):
    W.write_archive(pages(spark, PAGES[:3]), str(tmp_path / "a"))
    (tmp_path / "a" / ".part-00000000-00000-lost.tmp").write_bytes(b"half a file")
    manifest = W.write_archive(pages(spark, PAGES[:3]), str(tmp_path / "a"))
    assert not [f for f in os.listdir(tmp_path / "a") if f.endswith(".tmp")] and W.read_archive(manifest, str(tmp_path / "a")).count() == 3


def test_shard_plan_equals_running_sums(spark):
    import random

    rng = random.Random(3)
    sizes = {b: rng.randint(0, 5000) for b in rng.sample(range(-1, 3000), 700)}
    rows = spark.createDataFrame([(b, n) for b, n in sizes.items()], "bin bigint, size bigint")
    got = {r["bin"]: (r["parts"], r["first_shard"]) for r in W._shard_plan(rows, 4000).collect()}
    done = extra = 0
    for b in sorted(sizes):
        parts = -(-(sizes[b] + 600) // 4000)
        assert got[b] == (parts, done // 4000 + extra)
        done, extra = done + sizes[b] + 600, extra + parts - 1
