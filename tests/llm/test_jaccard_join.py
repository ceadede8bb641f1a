import itertools
import random
import re

import numpy as np

from reviewloom import Workspace
from reviewloom.llm import jaccard_join as J
from tests.llm.conftest import prose

EMPTY_CASES = [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two")]


def brute(rows, k, percent):
    low = {c: c + 32 for c in range(65, 91)}
    sets = {}
    for d, x in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(low))
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    links = {d: set() for d in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            if sets[a] != sets[b]:
                links[a].add(frozenset(sets[b]))
                links[b].add(frozenset(sets[a]))
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(s), find(d), len(links[d])) for d, s in sets.items()}


def near_copies(seed, n, base):
    """Copies of one text with a growing number of changed words: some link, some do not, some by way of others."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        w = prose(seed, 120).split()
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"changed{rng.randrange(10**6)}"
        rows.append((base + i, " ".join(w)))
    return rows


def test_components_and_links_match_brute_force(frame):
    rows = EMPTY_CASES + [(i, prose(i, 60)) for i in range(12)] + near_copies(5, 40, 100) + near_copies(6, 25, 200) + [(300, prose(1, 60)), (301, prose(1, 60).upper())]
    for k, percent in ((3, 90), (5, 80)):
        want = brute(rows, k, percent)
        for chunk in (400, 7):  # whole families, and families cut into chunks
            out = J.link_documents(frame(rows), words=k, percent=percent, chunk=chunk, near=chunk + 2).collect()
            assert len(out) == len(rows)
            assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in out} == want


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, percent = int(rng.integers(5, 400)), int(rng.choice([70, 80, 90]))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        cut = int(rng.integers(0, max(1, n * (100 - percent) // 100)))
        b = np.concatenate([a[cut:], rng.integers(0, 2**63, int(rng.integers(0, 3))).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)) and len(np.setxor1d(a, b)):
            known = np.unique(np.concatenate([a[::3], b[::2]]))
            for levels in (J.NO_LEVELS, J.Levels(known, rng.integers(3, 1000, len(known)))):
                assert len(np.intersect1d(J.block_keys(a, percent, levels=levels), J.block_keys(b, percent, levels=levels)))


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, int(rng.integers(1, 300))).astype(np.uint64)
        sets += [np.unique(base), np.unique(base[rng.integers(0, 3) :]), np.unique(np.concatenate([base[len(base) // 8 :], rng.integers(0, 2**63, 3).astype(np.uint64)]))]
    sets = [s for s in sets if len(s)]
    rows = [(len(s), J.parity_sketch(s)) for s in sets]
    for percent in (70, 80, 90):
        linked = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))}
        within = set(zip(*(x.tolist() for x in J.close_pairs(rows, None, percent, at_once=50))))
        assert linked <= within and len(within) < 5 * len(linked)
        half = len(rows) // 2
        across = {(int(i), int(j) + half) for i, j in zip(*J.close_pairs(rows[:half], rows[half:], percent))}
        assert across == {(i, j) for i, j in within if i < half <= j}


def test_a_shared_passage_ties_no_strangers(frame):
    """Documents that share a long passage, each with text of its own, and near copies of some of them."""
    passage = prose(77, 120)
    rows = [(i, prose(1000 + i, 200) + " " + passage) for i in range(60)] + [(100 + i, prose(1000 + i, 200) + " " + passage + " tail") for i in range(20)]
    rows += [(200 + i, prose(2000 + i, 60) + " " + passage) for i in range(20)]  # over half of it shared: strangers still
    want = brute(rows, 5, 80)
    out = J.link_documents(frame(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in out} == want
    sets = [J.shingle_set(x.encode(), 5) for _, x in rows]
    shingles, seen = np.unique(np.concatenate(sets), return_counts=True)
    levels = J.Levels(shingles[seen >= 3], seen[seen >= 3])
    keys = [set(J.block_keys(s, 80, levels=levels).tolist()) for s in sets[:80]]
    assert sum(bool(a & b) for a, b in itertools.combinations(keys, 2)) <= 25  # 20 pairs link
    within = J.close_pairs([(len(s), J.parity_sketch(s)) for s in sets], None, 80)
    assert len(within[0]) == 20


def test_texts_of_one_id_and_weak_chains(frame):
    """A chain of texts in which only neighbours link, and an id with a second text that is in no family."""
    words, rows = prose(5, 600).split(), []
    for i in range(12):
        rows.append((i, " ".join(words[i * 8 : i * 8 + 200])))
    rows.append((3, prose(9, 50)))
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["n_links"]) for r in J.link_documents(frame(rows)).collect()}
    want = brute(rows[:12], 5, 80)
    assert {k[0]: (k[1], *v) for k, v in got.items() if k[1] > 100} == want


def test_repeated_and_missing_ids(frame):
    rows = [(1, prose(1, 50)), (1, prose(1, 50)), (2, prose(1, 50)), (None, prose(1, 50)), (None, None)]
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in J.link_documents(frame(rows)).collect())
    assert [x[2] for x in got] == [None, None, 1, 1, 1]
    assert J.keep_representatives(frame(rows)).count() == 4  # id 1 twice, and the rows without id


def test_empty_table(frame):
    assert J.link_documents(frame([])).count() == 0


def test_words_over_the_power_table():
    long = b"x" * 70_000
    assert J.word_hashes(long + b" y")[0] == J.word_hashes(long)[0] != J.word_hashes(long + b"x")[0]


def test_components_of_chains_trees_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200 + i, 200 + (i * 7 + 3) % 60) for i in range(60)] + [(300, 300 + i) for i in range(1, 30)] + [(rng.randrange(400, 600), rng.randrange(400, 600)) for _ in range(150)]
    parent = {v: v for e in edges for v in e}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    met = {v for a, b in edges if a != b for v in (a, b)}
    out = J.components(spark.createDataFrame(edges, "a bigint, b bigint"), Workspace(spark, "components"), "t").collect()
    assert len(out) == len(met) and {r["v"]: r["label"] for r in out} == {v: find(v) for v in met}
