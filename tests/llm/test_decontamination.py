import itertools
import math
import random
import re

from reviewloom.llm import decontamination as D
from tests.llm.conftest import prose


def items(spark, texts):
    return spark.createDataFrame(list(texts.items()), "item_id bigint, text string")


def planted():
    item = prose(70, 40)
    words = item.split()
    some = " ".join("new" if i in (9, 17, 29) else w for i, w in enumerate(words))
    rows = [
        (1, f"{prose(1, 90)} {item} {prose(2, 40)}"),          # exact
        (2, f"{prose(3, 90)}\n{some.upper()}, {prose(4, 40)}"),  # other words and case
        (3, " ".join(words[:20]) + " " + prose(5, 40)),          # a part, at the start
        (4, prose(6, 40) + " " + " ".join(words[-16:])),         # a part, at the end
        (5, prose(7, 200)), (6, None), (7, ""), (8, " ".join(words[:6])), (None, item), (9, " ".join(words[i] if i % 3 else "q" for i in range(40))),
    ]
    return {11: item, 12: prose(71, 30), 13: None, 14: "", 15: "too short"}, rows


def test_exact_substituted_and_partial_leaks_are_found(frame, spark):
    bench, rows = planted()
    out = {(r["doc_id"], r["item_id"]): r for r in D.find_leaks(frame(rows), items(spark, bench)).collect()}
    assert set(out) == {(1, 11), (2, 11), (3, 11), (4, 11)}
    assert (out[1, 11]["first_token"], out[1, 11]["n_matched"], out[1, 11]["n_item_tokens"]) == (90, 40, 40)
    assert out[2, 11]["n_matched"] == 37


def test_blocks_give_the_same_result(frame, spark):
    bench, rows = planted()
    one = D.find_leaks(frame(rows), items(spark, bench)).collect()
    many = D.find_leaks(frame(rows), items(spark, bench), block_tokens=10).collect()
    assert sorted(one) == sorted(many)


def test_clean_documents_stay_with_all_columns(frame, spark):
    bench, rows = planted()
    docs = frame(rows + [(5, prose(7, 200))])
    out = D.drop_leaking(docs, items(spark, bench))
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in out.collect()) == [-1, 5, 5, 6, 7, 8, 9]


def test_empty_tables(frame, spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.find_leaks(frame([]), none).count() == 0
    assert D.drop_leaking(frame([(1, "a")]), none).count() == 1


def test_native_plan(frame, spark):
    bench, rows = planted()
    plan = D.find_leaks(frame(rows), items(spark, bench))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_masks_meet_every_accepted_pattern():
    for n in range(D.SEEDS[-1][0], 14):
        masks = next(m for least, m in D.SEEDS if n >= least)
        need = n if n < D.WHOLE_BELOW else math.ceil(0.75 * n)
        for agree in map(set, itertools.combinations(range(n), need)):
            assert any(all(i + k in agree for k, sign in enumerate(m) if sign == "1") for m in masks for i in range(n - len(m) + 1)), (n, agree)


def brute(docs, bench):
    """(document, item) -> best number of agreeing tokens over accepted diagonals."""
    out = {}
    for (d, x), (k, y) in itertools.product(docs, bench.items()):
        words, item = ([w for w in re.split(r"[^a-z0-9]+", (z or "").lower()) if w] for z in (x, y))
        n = len(item)
        if d is None or n < 4:
            continue
        width = min(13, n)
        need = n if n < 8 else math.ceil(0.75 * width)
        for shift in range(1 - n, len(words)):
            agree = [i for i in range(n) if 0 <= i + shift < len(words) and words[i + shift] == item[i]]
            if any(agree[j + need - 1] - agree[j] < width for j in range(len(agree) - need + 1)):
                out[d, k] = max(out.get((d, k), 0), len(agree))
    return out


def test_equals_brute_force(frame, spark, monkeypatch):
    monkeypatch.setattr(D, "HITS", 3)
    rng = random.Random(5)
    bench = {n: " ".join(f"w{rng.randrange(400)}" for _ in range(n)) for n in (3, 4, 5, 7, 8, 8 + 32, 9, 10, 11, 12, 13, 14, 15, 20)} | {99: "a a a a a a a a a", 98: None}
    rows = [(900, "a " * 60), (901, None), (902, ""), (None, bench[20])]
    for d in range(250):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(0, 30))]
        item = bench[rng.choice([k for k in bench if k < 98])].split()
        for _ in range(rng.randrange(0, 5)):
            item[rng.randrange(len(item))] = "other"
        cut = rng.choice([0, 0, 0, 1, 2])
        at = rng.choice([0, len(words) // 2, len(words)])
        rows.append((d, " ".join(words[:at] + item[cut:] + words[at:])))
    want = brute(rows, bench)
    out = D.find_leaks(frame(rows), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"]): r["n_matched"] for r in out} == want and len(out) == len(want) > 100


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, prose(1, 30), 5, 6, 7), (2, prose(2, 30), 5, 6, 7)], "doc_id bigint, text string, _leak int, _doc int, _item int")
    out = D.drop_leaking(docs, items(spark, {1: prose(1, 30)}))
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == [2]
