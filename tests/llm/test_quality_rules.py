import collections
import math
import random
import re

import xxhash

from reviewloom.llm import quality_rules as Q
from tests.llm.conftest import prose

ROWS = [(0, None), (1, ""), (2, "\n \t"), (3, "a b\na b\n\nc"), (4, "x y z " * 40), (5, prose(5, 200)), (5, prose(5, 200)), (6, " ".join(w + "***" for w in prose(6, 90).split())),
        (None, prose(7, 80)), (8, "one two three four"), (9, "#|<>&$%* é # two words"), (10, prose(10, 60) + "\n" + prose(10, 60))]


def base(x):
    x = x or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", x)
    windows = list(zip(words, words[1:], words[2:]))
    many, inside = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
    return (len(words), sum(map(len, words)), sum(x.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside), len(words) < 50 or 100 * len(inside) > 50 * len(words))


def test_base_counts(frame, spark):
    out = Q.judge_documents(frame(ROWS), spark.createDataFrame([(5,)], "doc_id bigint")).collect()
    key = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert collections.Counter((r["doc_id"], *[r[k] for k in key]) for r in out) == collections.Counter((d, *base(x)) for d, x in ROWS)


def test_long_texts_sort_pairs(frame, spark, monkeypatch):
    monkeypatch.setattr(Q, "_POSITION_MASK", 7)
    monkeypatch.setattr(Q, "_POSITION_BITS", 3)
    out = Q.judge_documents(frame(ROWS), spark.createDataFrame([(5,)], "doc_id bigint")).collect()
    assert collections.Counter((r["doc_id"], r["n_repeat_words"]) for r in out) == collections.Counter((d, base(x)[4]) for d, x in ROWS)


def test_ratio_tells_junk_from_prose(frame, spark):
    rows = [(i, prose(i, 150)) for i in range(20)] + [(100 + i, " ".join(w + "###" for w in prose(i, 150).split())) for i in range(10)]
    kept = {r["doc_id"] for r in Q.keep_documents(frame(rows), spark.createDataFrame([(i,) for i in range(10)], "doc_id bigint")).collect()}
    assert kept == set(range(20))


def test_without_trusted_text_only_base_rules_decide(frame, spark):
    none = spark.createDataFrame([], "doc_id bigint")
    assert Q.keep_documents(frame(ROWS), none).columns == frame(ROWS).columns
    assert {r["kept"] for r in Q.judge_documents(frame([(1, prose(1, 90))]), none).collect()} == {True}
    assert Q.judge_documents(frame([]), none).count() == 0


def features(text, buckets, n):
    """As the module states them; Spark hashes several columns one after the other, each seeded by the one before."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def h(*parts):
        seed = 42
        for x in parts:
            seed = xxhash.xxh64_intdigest(x.encode(), seed)
        return (seed - (1 << 64) if seed >> 63 else seed) % buckets

    return [h(w) for w in words] + [buckets + h(w[-n:]) for w in words] + [2 * buckets + h(v, w) for v, w in zip(words, words[1:])]


def test_ratio_equals_brute_force(frame, spark):
    rows = ROWS + [(i, prose(i, 70)) for i in range(20, 30)]
    trusted, buckets = {5, 10, 20, 21, 22}, 97
    raw, target = collections.Counter(), collections.Counter()
    for d, x in rows:
        raw.update(features(x, buckets, 3))
        target.update(features(x, buckets, 3) if d in trusted else [])
    base_ = math.log(sum(target.values()) + len(raw)) - math.log(sum(raw.values()) + len(raw))
    weight = {b: round(1e6 * (math.log(target[b] + 1) - math.log(raw[b] + 1) - base_)) for b in raw}
    want = collections.Counter()
    for d, x in rows:
        f = features(x, buckets, 3)
        total = sum(weight[b] for b in f)
        want[d, round(total / (1e6 * len(f)), 9) if f else 0.0, not base(x)[5] and total >= -10_000 * len(f)] += 1
    out = Q.judge_documents(frame(rows), spark.createDataFrame([(d,) for d in trusted], "doc_id bigint"), buckets=buckets, threshold=-0.01).collect()
    assert collections.Counter((r["doc_id"], round(r["ratio_score"], 9), r["kept"]) for r in out) == want


def test_order_of_words_counts(frame, spark):
    rows = [(i, prose(i, 150)) for i in range(20)]
    words = rows[0][1].split()
    random.Random(1).shuffle(words)
    out = {r["doc_id"]: r["ratio_score"] for r in Q.judge_documents(frame(rows + [(50, " ".join(words))]), spark.createDataFrame([(i,) for i in range(10)], "doc_id bigint")).collect()}
    assert out[50] < out[0]
