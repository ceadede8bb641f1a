from reviewloom.llm.licence_scan import SENTENCES, scan_licences
from tests.llm.conftest import prose

MIT = """MIT License

Copyright (c) 2001 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""


def scan(frame, rows):
    return {r["doc_id"]: r for r in scan_licences(frame(rows)).collect()}


def test_notices_and_texts(frame):
    out = scan(frame, [
        (1, f"{prose(1, 30)}.\nReleased under the MIT License."), (2, f"{prose(2, 30)} no stop\nLICENSED under the Apache License,  Version 2.0"), (3, MIT), (4, prose(4, 90)), (5, None), (6, ""),
        (7, "Licensed under CC BY-NC 4.0.\nAll rights reserved."), (8, "See the GNU General Public License for more details."), (9, "my license to cook"),
        (10, "# This work is licensed under the GNU General Public\n# License, version 3.\n"),
    ])
    assert out[1]["licence"] == "MIT" and out[2]["licence"] == "Apache-2.0" and out[10]["licence"] == "GPL-3.0-only"
    assert out[3]["sentence_ids"] == ["MIT_TITLE", "MIT_GRANT", "MIT_CONDITION"] and out[3]["licences"] == ["MIT"] and out[3]["unmatched"] == []
    assert out[7]["licences"] == ["CC-BY-NC-4.0", "All-Rights-Reserved"]
    assert out[8]["licence"] is None and out[8]["unmatched"] == ["GPL_SEE"]
    assert all(out[i]["licence"] is None and out[i]["sentence_ids"] == [] for i in (4, 5, 6, 9))


def test_every_known_sentence_is_recognised(frame):
    rows = [(i, f"{prose(i, 5)}.\n{s}.") for i, (_, s) in enumerate(SENTENCES) if ". " not in s]
    out = scan(frame, rows)
    for i, (name, s) in enumerate(SENTENCES):
        if i in out:
            assert name in out[i]["sentence_ids"], s


def test_sentences_with_stops_wrapped_ones_and_those_of_the_caller_are_recognised(frame):
    rows = [(i, f"{prose(i, 5)}.\n{s}.") for i, (_, s) in enumerate(SENTENCES)] + [(100 + i, s.replace(" ", "\n")) for i, (_, s) in enumerate(SENTENCES)]
    out = scan(frame, rows)
    for i, (name, s) in enumerate(SENTENCES):
        assert name in out[i]["sentence_ids"] and name in out[100 + i]["sentence_ids"], s
    assert out[[n for n, _ in SENTENCES].index("MPL2_NOTE")]["licence"] == "MPL-2.0"
    own = [("OWN", "Use it e.g. at home")]
    assert {r["licence"] for r in scan_licences(frame([(1, "use it e.g. at\nhome."), (2, "Well. Use it e.g. at home. Yes")]), sentences=own, rules=[("Own", "OWN")]).collect()} == {"Own"}


def test_plan_is_native_and_without_shuffle(frame):
    plan = scan_licences(frame([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert scan_licences(frame([])).count() == 0
