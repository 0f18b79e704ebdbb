"""The pipeline's stages against brute force, each on what its predecessor kept."""

import os
from collections import Counter

import pytest

from tests.llm.test_operators import plain_components

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_stages(spark):
    import corpus_pipeline
    from daystack.llm.common import load

    docs = load(spark, DIR, "documents")
    columns, seen = docs.columns, {}
    before = [r.asDict() for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR)
        if name != "packing":
            assert out.columns == columns
        rows = [r.asDict() for r in out.collect()]
        seen[name] = (before, rows)
        before, docs = rows, spark.createDataFrame(out.collect(), out.schema)
    a, b = seen["language_id"]
    assert [r["doc_id"] for r in b] and {r["doc_id"] for r in a if any(c.isalpha() for c in r["text"])} == {r["doc_id"] for r in b}
    a, b = seen["exact_dedup"]
    last = {}
    for r in a:
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert {r["doc_id"] for r in b} == set(last.values())
    a, b = seen["near_dedup"]
    assert {r["doc_id"] for r in b} == {c for _, c in plain_components([(r["doc_id"], r["text"]) for r in a]).values()}
    a, b = seen["source_mixing"]
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert max(Counter(r["doc_id"] for r in b).values()) <= 2 and abs(words(b) - 1.5 * words(a)) < 0.01 * words(a)
    a, b = seen["packing"]
    assert Counter(r["doc_id"] for r in b if r["piece"] == 0) == Counter(r["doc_id"] for r in a)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_run(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, DIR).count() > 0
