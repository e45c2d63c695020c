"""Every operator and pipeline stage on odd and on empty tables."""

import pytest

import corpus_pipeline
from turnstile.llm import (
    decontaminate,
    knn_quality,
    line_crf,
    minhash,
    packing,
    phrases,
    pseudo_likelihood,
    secret_scan,
    sharding,
    token_files,
)

BY_ROW = {
    "shards": lambda d, b, q: sharding.shard_report(d),
    "tokens": lambda d, b, q: token_files.token_report(d),
    "quality": lambda d, b, q: knn_quality.quality_report(d, q),
    "likelihood": lambda d, b, q: pseudo_likelihood.score_documents(d),
    "phrases": lambda d, b, q: phrases.repeat_report(d),
    "near": lambda d, b, q: minhash.near_duplicates(d),
    "lines": lambda d, b, q: line_crf.line_report(d),
    "secrets": lambda d, b, q: secret_scan.secret_report(d),
}


@pytest.mark.parametrize("name", BY_ROW)
def test_a_row_for_each_row(name, odd, benchmark, labels):
    found = BY_ROW[name](odd, benchmark, labels).collect()
    key = lambda ids: sorted(ids, key=lambda i: (i is not None, i))
    assert key(r.doc_id for r in found) == key(r.doc_id for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", BY_ROW)
def test_empty_table(name, odd, benchmark, labels):
    assert BY_ROW[name](odd.limit(0), benchmark.limit(0), labels.limit(0)).collect() == []


def test_odd_near_duplicates(odd):
    found = minhash.near_duplicates(odd).collect()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert all(by_id[i].component_id == i and by_id[i].kept and by_id[i].n_shingles == 0 for i in (1, 2, 3))
    assert by_id[4].n_shingles == 1 and by_id[6].component_id == by_id[5].component_id == 5
    assert {(r.component_id, r.kept) for r in found if r.doc_id is None} == {(5, False), (None, True)}


def test_odd_passages(odd, benchmark):
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_passages(odd, benchmark).collect()}
    assert found == {(5, 1), (6, 1), (7, 1), (None, 1)}
    assert decontaminate.find_passages(odd, benchmark.limit(0)).collect() == []
    assert decontaminate.find_passages(odd.limit(0), benchmark).collect() == []
    kept = decontaminate.clean_documents(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == 9


def test_odd_pieces(odd):
    pieces = packing.piece_report(odd).collect()
    tokens = sum(r.length for r in pieces)
    assert sum(r.doc_tokens for r in pieces if r.start == 0) == tokens
    assert {r.doc_tokens for r in pieces if r.doc_id in (1, 2, 3)} == {1}
    assert packing.piece_report(odd.limit(0)).collect() == []


@pytest.mark.parametrize("size", [0, 14])
def test_stages(spark, odd, size):
    docs = odd.limit(size)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, "/root/testdata/sf0.001")
        if name != "packing":
            assert found.columns == odd.columns and found.schema == odd.schema
            docs = found
        found.collect()


def test_masked_text(spark, odd):
    masked = {r.doc_id: r for r in secret_scan.mask_secrets(odd).collect()}
    assert masked[10].text == "[secret]\"" and masked[10].n_chars == 9
    assert masked[1].text is None and masked[1].n_chars is None
