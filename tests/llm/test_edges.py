"""Every operator on odd rows, on none, and on rows without ids."""

import pytest

from daystack.llm import fingerprint, jaccard_join, language_id, language_model, mixing, pii, quality, toxicity
from daystack.llm.catalogue import tokenizer_path
from daystack.llm.exact_dedup import exact_dedup, keep_one
from daystack.llm.packing import pack


def labels(docs):
    return docs.sparkSession.createDataFrame([(1, 1, 0), (4, 0, None), (6, None, 1), (None, 1, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "pack": lambda d: pack(d, tokenizer_path()),
    "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels(d))),
    "quality": lambda d: quality.classify(d.withColumnRenamed("source", "host").withColumnRenamed("lang", "path"), quality.train(d, labels(d))),
    "exact_dedup": exact_dedup,
    "mix": mixing.mix,
    "score": language_model.score,
    "identify": lambda d: language_id.identify(d, language_id.train(d)),
    "pii": pii.personal_data_digest,
    "jaccard": jaccard_join.jaccard_components,
    "fingerprint": fingerprint.fingerprint_edits,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd, name):
    rows = OPERATORS[name](odd).collect()
    assert len(rows) >= 10 and {r.doc_id for r in rows} == set(range(1, 10))
    if name != "pack":
        assert len(rows) == 10


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(nothing, name):
    assert OPERATORS[name](nothing).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_no_ids(no_id, name):
    assert len(OPERATORS[name](no_id).collect()) == 4


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_values_of_odd_rows(odd):
    """What each operator makes of null, blank, very long, repeated and lettersless texts."""
    got = {name: OPERATORS[name](odd).collect() for name in ("pack", "exact_dedup", "mix", "identify", "pii", "jaccard", "fingerprint")}
    pieces = [r for r in got["pack"] if r.doc_id == 7]
    assert [r.length for r in sorted(pieces, key=lambda r: r.piece)] == [4096] * 7 + [30_001 - 7 * 4096]
    assert [(r.length, r.piece) for r in got["pack"] if r.doc_id in (3, 4, 5)] == [(1, 0)] * 3
    same = by_id(got["exact_dedup"])
    assert (same[1].keep_id, same[1].group_size, same[1].kept) == (2, 2, False) and (same[3].keep_id, same[4].kept) == (4, True)
    assert (same[8].keep_id, same[8].group_size, same[8].kept) == (8, 2, True) and same[5].group_size == 1
    sizes = by_id(got["mix"])
    assert [sizes[k]["size"] for k in (1, 3, 4, 5, 6, 7, 8)] == [18, 0, 0, 0, 1, 30_000, 4]
    found = by_id(got["identify"])
    assert {k: found[k].lang_pred for k in (3, 4, 5, 7, 8)} == {3: "und", 4: "und", 5: "und", 7: "de", 8: "und"}
    private = by_id(got["pii"])
    assert (private[9].n_email, private[9].n_ip, private[9].n_phone, private[3].n_email, private[7].n_card) == (1, 1, 1, 0, 0)
    near = by_id(got["jaccard"])
    assert [(near[k].n_shingles, near[k].component_id) for k in (1, 2, 3, 4, 5, 6, 7, 8)] == [(14, 1), (14, 1), (0, 3), (0, 4), (0, 5), (1, 6), (1, 7), (1, 8)]
    prints = by_id(got["fingerprint"])
    assert prints[1].fingerprint == prints[2].fingerprint and prints[1].near_next == 1.0
    assert prints[3].fingerprint == "" and prints[3].near_next == 1.0 and prints[7].n_chars == 150_000


def test_stages_take_columns_of_any_name(odd):
    clashing = odd.selectExpr("*", "1 AS _kept_id", "2 AS _doc", "3 AS _copies", "4 AS _round", "5 AS __doc")
    for stage in (keep_one, jaccard_join.keep_one_similar, mixing.mixed, language_id.with_known_language):
        out = stage(clashing)
        assert out.columns == clashing.columns and {(r._kept_id, r._doc, r._copies, r._round) for r in out.collect()} == {(1, 2, 3, 4)}


def test_stages_of_odd_rows(odd):
    assert sorted(r.doc_id for r in keep_one(odd).collect()) == [2, 4, 5, 6, 7, 8, 8, 9]
    assert sorted(r.doc_id for r in jaccard_join.keep_one_similar(odd).collect()) == [1, 3, 4, 5, 6, 7, 8, 8, 9]
    assert {1, 2, 6, 7, 9} == {r.doc_id for r in language_id.with_known_language(odd).collect()}
    assert {3, 4, 5} <= {r.doc_id for r in mixing.mixed(odd).collect()}


@pytest.mark.parametrize("stage", [keep_one, jaccard_join.keep_one_similar, mixing.mixed, language_id.with_known_language])
def test_stages_keep_columns(odd, nothing, stage):
    assert stage(odd).columns == odd.columns
    stage(odd).collect()
    assert stage(nothing).collect() == []
