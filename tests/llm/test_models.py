import collections
import math
import zlib

import numpy as np

from reviewloom.llm import lm_scoring as L
from reviewloom.llm import quality_classifier as C
from reviewloom.llm import toxicity as X
from tests.llm.conftest import prose


def remainder(d, parts):
    return zlib.crc32(str(d).encode()) % parts


# --- language model

def test_scores_match_a_direct_computation(frame):
    rows = [(i, prose(i, 20 + i)) for i in range(30)] + [(40, None), (41, ""), (42, "The AN \n the"), (43, "ÉÀ x"), (None, "an er")]
    out = {r["doc_id"]: r for r in L.score_documents(frame(rows), frequent=20).collect()}
    low = lambda x: [w.encode() for w in (x or "").translate({c: c + 32 for c in range(65, 91)}).split()] + [None]
    count = collections.Counter(w for d, x in rows if d is None or remainder(d, 5) != 1 for w in low(x))
    n, v = sum(count.values()), len(count)
    for d, x in rows:
        r, words = out[d], low(x)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (d is not None and remainder(d, 5) == 1, len(words), sum(count[w] > 0 for w in words), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), rel_tol=1e-9)
        assert r["score"] < 0


def tree_of(text, depth):
    grams, n = np.unique(L.grams_of(text, depth), return_counts=True)
    counts = []
    for d in range(depth + 1):
        g, i = np.unique(grams & ((1 << (8 * (d + 1))) - 1), return_inverse=True)
        counts.append((g, np.bincount(i, n).astype(np.int64)))
    return counts


def test_context_tree_matches_the_recursion():
    text, depth = b"abracadabra abracadabra banana", 2
    tree = L.build_tree(tree_of(text, depth))
    padded = bytes(depth) + text + b"\0"
    steps = [(padded[i : i + depth], padded[i + depth]) for i in range(len(text) + 1)]

    def counts(context, level, prefix):
        bits = [(y >> (7 - level)) & 1 for c, y in steps if c.endswith(context) and y >> (8 - level) == prefix]
        return len(bits) - sum(bits), sum(bits)

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def children(context):
        return sorted({c[len(c) - len(context) - 1 :] for c, _ in steps if c.endswith(context)})

    def log_weighted(context, level, prefix):
        own = log_kt(*counts(context, level, prefix))
        if len(context) == depth:
            return own
        return np.logaddexp(own, sum(log_weighted(c, level, prefix) for c in children(context))) - math.log(2)

    def one(path, level, prefix, above):
        a, b = counts(path[0], level, prefix)
        mine = (b + 0.5) / (a + b + 1) if a + b else above
        if len(path) == 1:
            return mine
        split = sum(log_weighted(c, level, prefix) for c in children(path[0]))
        share = 1 / (1 + math.exp(split - log_kt(a, b)))
        return share * mine + (1 - share) * one(path[1:], level, prefix, mine)

    want = 0.0
    for context, byte in steps:
        for level in range(8):
            p = one([context[depth - d :] for d in range(depth + 1)], level, byte >> (8 - level), 0.5)
            want += math.log10(p if (byte >> (7 - level)) & 1 else 1 - p)
    assert math.isclose(tree.log10(text), want, rel_tol=1e-4)


def test_probabilities_of_a_tree_sum_to_one():
    tree = L.build_tree(tree_of(prose(1, 200).encode(), 3))
    assert np.allclose((10.0 ** tree.table.astype(np.float64)).sum(axis=1), 1, atol=1e-4)


def test_scores_are_those_of_the_whole_tree(frame, monkeypatch):
    rows = [(i, prose(i, 5 + i)) for i in range(12)] + [(40, None), (41, ""), (43, "ÉÀ x"), (None, "an er"), (0, prose(0, 5))]
    monkeypatch.setattr(L, "_CHUNK", 60)
    out = [r["score"] for r in L.score_documents(frame(rows), depth=4).orderBy("doc_id", "score").collect()]
    grams = np.concatenate([L.grams_of((x or "").encode(), 4) for d, x in rows if d is None or remainder(d, 5) != 1])
    counts = []
    for d in range(5):
        counts.append(np.unique(grams & ((1 << (8 * (d + 1))) - 1), return_counts=True))
    tree = L.build_tree(counts)
    want = sorted((-1 if d is None else d, tree.log10((x or "").encode())) for d, x in rows)
    assert np.allclose(out, [w for _, w in want], rtol=1e-4)


def test_rare_contexts_stay_when_the_corpus_is_large(frame):
    import random

    rng = random.Random(1)
    large = ["".join(chr(rng.randrange(58, 122)) for _ in range(600)) for _ in range(50)] * 20  # 90,000 contexts, each met 20 times
    rare = "".join(rng.choice("0123456789") for _ in range(400))
    ids = [i for i in range(2000) if remainder(i, 5) != 1]
    held = next(i for i in range(2000, 3000) if remainder(i, 5) == 1)
    out = {r["doc_id"]: r for r in L.score_documents(frame([*zip(ids, large + [rare] * 8), (held, rare)])).collect()}
    assert out[held]["held_out"] and out[held]["bits_per_byte"] < 1.3


def test_language_model_of_an_empty_table(frame):
    assert L.score_documents(frame([])).count() == 0


# --- quality network

def test_chunks_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 511, 512, 513, 5000):
        data = bytes(range(1, 251)) * 21
        rows = C.chunks_of(data[:n])
        seen = np.concatenate([rows[0][:512], *[r[256:512] for r in rows[1:]]])
        assert seen[:n].tolist() == list(data[:n]) and (seen[n:] == 256).all()


def test_quality_scores(frame, spark):
    rows = [(i, prose(i, 80) if i % 2 else " ".join(w + "!!" for w in prose(i, 80).upper().split())) for i in range(160)] + [(500, None), (501, ""), (None, "a"), (1, prose(1, 80))]
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(160)], "doc_id bigint, quality int, score string")
    out = C.score_quality(frame(rows), labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 160 and r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(160) if remainder(i, 4) == 2}
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in held) >= 0.9 * len(held)


def test_quality_without_labels(frame, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in C.score_quality(frame([(1, "a"), (2, None)]), none).collect()} == {0.5}
    assert C.score_quality(frame([]), none).count() == 0


# --- toxicity

def test_toxic_documents_are_found_and_clean_ones_left_alone(frame, spark):
    bad = ["idiot", "moron", "trash", "scum", "achkeiter"]
    rows = [(i, prose(i, 60) + (f" {bad[i % 5]} {prose(i + 1000, 9)} {bad[(i + 1) % 5]}" if i % 3 == 0 else "")) for i in range(240)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(160)], "doc_id bigint, toxic int")
    out = {r["doc_id"]: r for r in X.score_toxicity(frame(rows), labels).collect()}
    later = range(160, 240)
    assert sum(out[i]["toxic"] for i in later if i % 3 == 0) >= 0.8 * sum(i % 3 == 0 for i in later)
    assert sum(out[i]["toxic"] for i in later if i % 3) <= 2 and not out[900]["toxic"] and not out[901]["toxic"]


def test_features_count_words_and_stems():
    text, want = "Idioten idiot IDIOT x1x idioti\nça idiot", set()
    counts = collections.Counter(["idioten", "idiot", "idiot", "x", "x", "idioti", "ça", "idiot"])
    names = collections.Counter()
    for w, n in counts.items():
        names[w] += n
        for k in (4, 5, 6, 7):
            if len(w) >= k:
                names["^" + w[:k]] += n
    for name, n in names.items():
        want |= {(X.xxhash.xxh3_64_intdigest(name) & ~3) | k for k, least in enumerate((1, 2, 4, 8)) if n >= least}
    assert X.Features()(text) == want
    some = set(sorted(want)[::3])
    assert X.Features(some)(text) == some and X.Features(some)("") == set()


def test_telling_features_are_those_of_the_largest_chi_square(spark):
    rng = np.random.default_rng(3)
    x, y = rng.random((60, 25)) < np.linspace(0.02, 0.9, 25), rng.integers(0, 2, 60)
    x[:, 24] |= y == 1
    rows = [(int(b), [int(h) - 12 for h in np.flatnonzero(r)]) for r, b in zip(x, y)]
    n, n1, scored = len(rows), int(y.sum()), []
    for h in range(25):
        k, bad = int(x[:, h].sum()), int(x[y == 1, h].sum())
        if k > 1:
            scored.append((-((bad - k * n1 / n) ** 2) * n / (k * n1 / n * (n - k) + 1e-9), h - 12))
    got = X.telling_features(spark.createDataFrame(rows, "y int, features array<bigint>"), 8)
    assert [h - (1 << 64) if h >> 63 else h for h in got] == [h for _, h in sorted(scored)[:8]]


def test_chain_feeds_out_of_fold_probabilities():
    rng = np.random.default_rng(5)
    x, y = (rng.random((90, 40)) < 0.3).astype(np.float32), np.repeat([0, 1], 45)
    x[45:60, 0], x[60:75, 1], x[75:, 2], x[:45, :3] = 1, 1, 1, 0
    fold, columns = np.arange(90) % 4, {h: h for h in range(40)}
    chain = X.train_chain(columns, x, y, fold)
    kinds, inputs = np.concatenate([X.learn_kinds(x, y), y[:, None]], axis=1), x
    assert not kinds[:45].any() and kinds[45:, : X.KINDS].any(axis=1).all()
    for k, w in enumerate(chain.weights):
        assert np.allclose(w, X.fit_linear(inputs, kinds[:, k]), atol=1e-5)
        # the next link sees, for every row, a model of the other folds only
        p = np.zeros(90, dtype=np.float32)
        for f in range(4):
            fitted = X.fit_linear(inputs[fold != f], kinds[fold != f, k])
            p[fold == f] = 1 / (1 + np.exp(-(inputs[fold == f] @ fitted[:-1] + fitted[-1])))
        inputs = np.concatenate([inputs, p[:, None]], axis=1)
    # a document goes through the links one after the other
    done = []
    for w in chain.weights:
        done.append(1 / (1 + math.exp(-float(np.append(x[70], done) @ w[:-1] + w[-1]))))
    assert np.allclose(chain.probabilities([set(np.flatnonzero(x[70]).tolist())])[0], done, atol=1e-5)


def test_kinds_are_clusters_of_features_that_stand_together():
    x, y = np.zeros((60, 9), dtype=np.float32), np.repeat([1, 0], 30)
    for i in range(30):
        x[i, [3 * (i % 3), 3 * (i % 3) + 1 + i % 2]] = 1
    labels = X.learn_kinds(x, y)
    assert len({tuple(labels[i::3][:10, : X.KINDS].ravel()) for i in range(3)}) == 3 and (labels[:30, : X.KINDS].sum(axis=1) == 1).all()


def test_toxicity_of_other_languages_repeated_ids_and_conflicting_labels(frame, spark):
    rows = [(i, prose(i, 60) + (f" schmutz{'abcdef'[i % 6]} {prose(i + 1000, 5)} schmutz{'bcdefa'[i % 6]}" if i % 3 == 0 else "")) for i in range(240)] + [(0, "a"), (0, None), (None, "b")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(160)] + [(0, 0), (3, None), (None, 1), (5, 7)], "doc_id bigint, toxic int")
    docs = frame(rows)
    for name in ("id", "y", "bits", "features"):
        docs = docs.withColumn(name, X.F.lit("x"))
    out = X.score_toxicity(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r[f"p_{c}"] <= 1 for r in out for c in X.CATEGORIES)
    hit = {r["doc_id"] for r in out if r["toxic"] and (r["doc_id"] or 0) >= 160}
    assert hit == {i for i in range(160, 240) if i % 3 == 0}


def test_toxicity_without_labels(frame, spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r["toxic"] for r in X.score_toxicity(frame([(1, "idiot"), (2, None)]), none).collect()} == {False}
    assert X.score_toxicity(frame([]), none).count() == 0


def test_strings_of_a_batch_are_numbered_piece_by_piece(monkeypatch):
    texts = [b"", b"abcabcabc", prose(1, 60).encode(), b"\x00\xff" * 40, prose(1, 60).encode()]
    want = np.concatenate([L.grams_of(x, 5) for x in texts])
    for step in (7, 1 << 18):
        monkeypatch.setattr(L, "_POSITIONS_AT_ONCE", step)
        grams, place, starts = L._strings_of(texts, 5)
        assert (grams[place] == want).all() and len(set(grams.tolist())) == len(grams)
        assert starts.tolist() == np.cumsum([0, *(len(x) + 1 for x in texts)])[:-1].tolist()


def test_texts_of_a_batch_travel_compressed(spark):
    texts = ["abc" * 1000, None, "", "é tail"] * 100
    rows = L._batches(spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "id long, text string, learnt boolean").coalesce(1), 5).where("bucket is null").collect()
    rows.sort(key=lambda r: r["key"])
    assert [r["id"] for r in rows] == list(range(len(texts)))
    assert sum(len(r["text"] or b"") for r in rows) < sum(len(t or "") for t in texts) / 5
    assert L._texts_of([r["size"] for r in rows], [r["text"] for r in rows]) == [(t or "").encode() for t in texts]
