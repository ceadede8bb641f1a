import random
import re
from collections import Counter

import pytest

from reviewloom.llm import source_divergence as S

SCHEMA = "doc_id bigint, text string, lang string, source string, value string, term string"


def brute(rows, least=10, top=10):
    """The contract, term by term."""
    known = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))) for text, lang, source in rows]
    out = set()
    for lang in {x[0] for x in known}:
        docs, all_, groups = Counter(), Counter(), {}
        for _, source, words in [x for x in known if x[0] == lang]:
            docs.update(set(words))
            all_.update(words)
            groups.setdefault(source, Counter()).update(words)
        kept = {w for w, n in docs.items() if n >= least}

        def shares(counts):
            total = sum(counts[w] for w in kept)
            return {w: 1 + 1_000_000_000 * (counts[w] + 2) // (total + 2 * len(kept)) for w in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {g: shares(c) for g, c in groups.items()}, shares(all_)
        for g, counts in groups.items():
            pairs = {h: sum(f(p[g][w], p[h][w]) for w in kept) for h in groups if h != g}
            terms = {w: f(p[g][w], q[w]) for w in kept if counts[w] and p[g][w] > q[w]}
            for part, values, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, g, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)}
    return out


def audit(spark, rows, **more):
    frame = spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], SCHEMA).repartition(3)
    got = S.audit_sources(frame, **more).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def corpus(seed, n, sources=6):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "Été", "ñandú", "delta", "x", "eps1lon", "日本", "zeta_eta", "I'm", "OMEGA", "ǅ"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    out = []
    for _ in range(n):
        source = f"s{min(rng.randrange(sources), rng.randrange(sources))}"  # s0 has most
        k = int(source[1:])
        out.append((" ".join(rng.choice(words[k : k + 30]) for _ in range(rng.randrange(40))), rng.choice(["en", "en", "en", "de"]), source))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed, 300)
    want = brute(rows)
    assert len({r[2] for r in want}) == 2 and audit(spark, rows) == want
    assert audit(spark, rows, postings=50) == want  # many blocks of terms


def test_many_groups_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(S, "_GROUPS", 2)
    monkeypatch.setattr(S, "ENTRIES", 20)
    rows = corpus(3, 200, sources=9)
    assert audit(spark, rows, least_docs=3) == brute(rows, least=3)


def test_odd_rows(spark):
    rows = corpus(4, 60) + [(None, "en", "silent"), ("", "en", "silent"), ("12 34 ...", "en", "digits"), ("alpha Beta", None, None), ("alpha", None, "s1"), ("only few words", "fr", "a"), ("few other words", "fr", "b"), ("lone", "it", "z")]
    rows += [("alpha " * 50_000 + "beta\x00gamma\x7fdelta", "en", "long")] + [("alpha beta", "en", "s0")] * 30  # a long text and repeated rows
    want = brute(rows)
    assert {("fr", "a", "pair", "b", 0, 1), ("fr", "b", "pair", "a", 0, 1)} <= want
    assert any(r[1] == "silent" for r in want) and audit(spark, rows) == want


def test_empty_table(spark):
    assert audit(spark, []) == set()


def test_no_kept_term_anywhere(spark):
    rows = [("one", "en", "a"), ("two", "en", "b"), ("two", "en", "c")]
    assert audit(spark, rows) == brute(rows)
