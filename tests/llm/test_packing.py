import collections
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from reviewloom.llm import sequence_packing as S  # noqa: E402
from tests.llm.conftest import prose  # noqa: E402

PATH = P.path("byte_bpe_50k.json")


def test_pieces_and_places(frame):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    rows = [(0, None), (1, ""), (2, "a"), (3, prose(3, 1500)), (4, "x <|endoftext|> y"), (5, "日本語\x1c\x85 tab\t\n\n  two"), (6, "a"), (6, "a"), (None, "b")] + [(i, prose(i, i * 7)) for i in range(10, 40)]
    out = S.pack_documents(frame(rows), tokenizer_path=PATH, content=F.crc32).collect()
    want = collections.Counter()
    for d, x in rows:
        ids, start = np.array(plain.encode(x or "", add_special_tokens=False).ids + [2], dtype="<u4"), 0
        for k, n in enumerate(S.cut_lengths(len(ids), 1024)):
            want[d, k, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
            start += n
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["content"]) for r in out) == want
    ends = collections.defaultdict(list)
    for r in out:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in ends.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(ends) <= -(-sum(r["length"] for r in out) // 1024) + 2


def test_blob_is_the_default_content(frame):
    r = S.pack_documents(frame([(1, "a")]), tokenizer_path=PATH).first()
    assert np.frombuffer(r["content"], dtype="<u4").tolist()[-1] == 2


def test_empty_table(frame):
    assert S.pack_documents(frame([]), tokenizer_path=PATH).count() == 0


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(1)
    histogram = collections.Counter(np.minimum(1024, rng.geometric(1 / 300, 20_000)).tolist())
    plan, used = S.plan_sequences(histogram, 1024), collections.Counter()
    for lengths, n in plan:
        assert sum(lengths) <= 1024
        for x in lengths:
            used[x] += n
    assert used == histogram
    assert sum(n for _, n in plan) <= 1.01 * -(-sum(k * v for k, v in histogram.items()) // 1024)


def test_never_more_sequences_than_best_fit():
    rng = np.random.default_rng(3)
    for lengths in (rng.integers(1, 65, 3000), np.clip(rng.lognormal(2.5, 0.8, 4000).astype(int), 1, 64), rng.choice([21, 22, 31, 43], 1000)):
        sizes, counts = np.unique(lengths, return_counts=True)
        histogram = dict(zip(sizes.tolist(), counts.tolist()))
        plan = S.plan_sequences(histogram, 64)
        used = {}
        for contents, n in plan:
            assert sum(contents) <= 64
            for size in contents:
                used[size] = used.get(size, 0) + n
        assert used == histogram
        plain = S.best_fit_decreasing({k: v for k, v in histogram.items() if k < 64}, 64)
        assert sum(n for _, n in plan) <= sum(n for _, n in plain) + histogram.get(64, 0)


def test_ids_of_parts_between_spaces_are_those_of_the_tokenizer(monkeypatch):
    import random

    from tokenizers import Tokenizer

    rng = random.Random(4)
    signs = ["a", "é", "'s", "'", "re", "1", " ", " ", "\n", "\t", "\xa0", ".", "!!", "x'll", "ß", " ", "<|endoftext|>"]
    texts = ["", " ", "  a", "a  ", *("".join(rng.choices(signs, k=rng.randrange(25))) for _ in range(3000))]
    plain = Tokenizer.from_file(PATH)
    want = [np.array(plain.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes() for x in texts]
    for most in (5, 1000):  # whatever is kept
        monkeypatch.setattr(S, "_CACHE_PIECES", most)
        monkeypatch.setattr(S, "_CACHE_WORDS", most)
        encoder = S._Encoder(PATH)
        assert [encoder.encode(x) for x in texts] == want
        assert max(len(k) + len(k.older) for k in (encoder.words, encoder.pieces)) <= 2 * most
