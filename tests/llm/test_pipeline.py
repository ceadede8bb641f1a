import os

import pytest

import corpus_pipeline as CP

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_stages_narrow_the_documents(spark):
    pytest.importorskip("public_tokenizers")
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, counts = docs.columns, []
    for name, stage in CP.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert all(r["text"] is None or len(r["text"]) == r["n_chars"] for r in docs.collect())
    assert CP.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct().count() == counts[-1]
