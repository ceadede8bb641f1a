import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import language_id as L

SF = "/root/testdata/sf0.01"


def plain_bundle(text, dimensions):
    """The bundle of a text, n-gram by n-gram."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    words = " ".join(letters.split())
    out = np.zeros(dimensions, dtype=np.int64)
    if words:
        padded = f" {words} "
        for at in range(len(padded) - 2):
            a, b, c = (L.letter_vector(ord(x), dimensions).astype(np.int64) for x in padded[at : at + 3])
            out += np.roll(a, 2) * np.roll(b, 1) * c
    return out


@pytest.mark.parametrize("text", ["", "a", "Ab, cd!", "  ünïcode 日本語 12 x ", "123 .,", "I I I", "𝔸 x 𐐷y"])
def test_bundle_equals_plain_sum(text):
    assert (L.bundle_texts([text, "other words"], 256)[0] == plain_bundle(text, 256)).all()


def test_pieces_of_long_texts_join(monkeypatch):
    text = "Some words, and   more -- of them; x1y " * 20
    whole = L.ngram_codes(text)
    for size in (1, 2, 3, 7, 50):
        monkeypatch.setattr(L, "_PIECE", size)
        assert (L.ngram_codes(text) == whole).all()


def rows():
    en, de = "the cat and the dog were there with them ", "der hund und die katze waren nicht mit ihnen "
    out = [(i, en * (1 + i % 3), "en", "s", 1) for i in range(10)] + [(i, de * (1 + i % 3), "de", "s", 1) for i in range(10, 20)]
    out += [(20, None, "en", "s", 1), (21, "", "de", "s", 1), (22, "12 ... 34", "de", "s", 1), (23, "the dog", None, None, None), (24, "die katze", None, None, None)]
    return out + [(None, "the cat", "xx", "s", 1), (25, "die katze und der hund " * 20_000, None, "s", 1), (25, "die katze und der hund " * 20_000, None, "s", 1)]


SCHEMA = "doc_id bigint, text string, lang string, source string, score int"


def find(spark, data, block=L.BLOCK, held=None):
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    held = F.col("doc_id") % 5 == 0 if held is None else held
    return Counter(map(tuple, L.identify_languages(docs, held, dimensions=512, block=block).collect()))


def test_equals_brute_force(spark):
    data = rows()
    sums = {}
    for i, text, lang, *_ in data:
        if i is not None and i % 5 and text and lang and any(c.isalpha() for c in text):
            sums[lang] = sums.get(lang, 0) + plain_bundle(text, 512)
    want = Counter()
    for i, text, *_ in data:
        held, b = i is None or i % 5 == 0, plain_bundle((text or "")[:2300], 512) * (1 if len(text or "") < 3000 else 1)
        if b.any():
            cosines = {x: float(b @ v / np.linalg.norm(b) / np.linalg.norm(v)) for x, v in sums.items()}
            best = min(cosines, key=lambda x: (-cosines[x], x))
            want[i, held, best] += 1
        else:
            want[i, held, "und"] += 1
    got = find(spark, data)
    assert Counter({(i, held, pred): n for (i, held, pred, _), n in got.items()}) == want
    assert all(0 <= s <= 1 and (s == 0) == (pred == "und") for (_, _, pred, s) in got)
    short = {i: s for (i, _, _, s) in got}
    b = plain_bundle("the dog", 512)
    assert short[23] == pytest.approx(b @ sums["en"] / np.linalg.norm(b) / np.linalg.norm(sums["en"]))


def test_blocks_of_prototypes_give_the_same(spark):
    data = rows() + [(30 + i, w * 3, lang, "s", 1) for i, (w, lang) in enumerate([("il gatto e il cane ", "it"), ("el gato y el perro ", "es"), ("le chat et le chien ", "fr")])]
    whole, cut = find(spark, data), find(spark, data, block=1)
    assert {k[:3]: round(k[3], 9) for k in whole} == {k[:3]: round(k[3], 9) for k in cut}


def test_nothing_to_learn_and_empty_table(spark):
    assert {k[2:] for k in find(spark, rows(), held=F.lit(True))} == {("und", 0.0)}
    assert find(spark, []) == {}


def test_ties_go_to_the_smaller_name(spark):
    data = [(1, "same words here", "zz", "s", 1), (2, "same words here", "aa", "s", 1), (5, "same words here", None, "s", 1)]
    assert {k[2] for k in find(spark, data)} == {"aa"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = L.identify_languages(docs, F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0).where("held_out")
    right = found.join(docs.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
