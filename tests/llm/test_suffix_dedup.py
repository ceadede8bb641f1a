import collections
import hashlib

import pytest

from reviewloom.llm import suffix_dedup as S
from tests.llm.conftest import prose


def brute(texts, length):
    data = [(x or "").encode() for x in texts]
    count = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        runs = []
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        kept, end = b"", 0
        for a, z in runs:
            kept, end = kept + b[end:a], z
        kept += b[end:]
        out.append((len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
    return out


def texts():
    passage, other = prose(50, 70), prose(51, 55)
    return [
        None, "", "short", "a" * 199, "a" * 200, "a" * 201, "b" * 1000, "xy" * 300,
        *[f"{prose(i, 60)} {passage} {prose(i + 100, 40)}" for i in range(6)],
        f"{passage} {prose(7, 30)} {passage}", f"{prose(8, 30)}é{other}é", f"{prose(9, 30)}è{other}è", prose(10, 80), prose(10, 80), "é" * 300, "ü" * 150 + prose(11, 90),
    ]


@pytest.mark.parametrize("most", [20_000, 2])
def test_matches_brute_force(frame, most):
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.removal(frame(rows), most=most).collect()}
    assert got == dict(enumerate(brute([x for _, x in rows], 200)))


def test_cleaned_texts_stay_valid_and_keep_columns(frame):
    rows = list(enumerate(texts()))
    out = {r["doc_id"]: r for r in S.clean_texts(frame(rows)).collect()}
    assert len(out) == len(rows) and out[0]["text"] is None and out[7]["kept"] == "en"
    passage = prose(50, 70)
    for i in range(8, 14):
        assert passage not in out[i]["text"] and out[i]["n_chars"] == len(out[i]["text"])
    plain = rows[4][1]
    assert out[3]["text"] == "a" * 199 or plain


def test_empty_table_and_missing_ids(frame):
    assert S.removal(frame([])).count() == 0
    assert {r["n_removed"] for r in S.removal(frame([(None, prose(1, 80)), (None, prose(1, 80))])).collect()} == {len(prose(1, 80).encode())}


def test_segments_find_the_same_anchors(monkeypatch):
    data = prose(3, 2000).encode()
    whole = S.anchors_of(data, 200, 80)
    monkeypatch.setattr(S, "_SEGMENT", 1500)
    parts = S.anchors_of(data, 200, 80)
    assert whole[0].tolist() == parts[0].tolist()


def test_anchors_are_gone_before_texts_are_shuffled(frame, monkeypatch):
    import os

    held, write = {}, S.Workspace.write

    def spy(self, df, name="table"):
        held[name] = set(os.listdir(self.root.removeprefix("file:"))) if os.path.exists(self.root.removeprefix("file:")) else set()
        return write(self, df, name)

    monkeypatch.setattr(S.Workspace, "write", spy)
    S.removal(frame(list(enumerate(texts())))).collect()
    assert held["found"] == {"places"}
    assert held["cuts"] == {"found"}
