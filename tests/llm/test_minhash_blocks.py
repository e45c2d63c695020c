"""Comparison of nodes inside tasks: blocks, samples and components against plain comparison of all sets."""

import random

import pytest

from turnstile.llm import common, minhash


def groups(seed, size):
    """Copies of a few texts with words replaced at several rates: chains of links, and many pairs just below one."""
    r = random.Random(seed)
    texts = []
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(120)]
        for _ in range(size):
            rate = r.choice([0.02, 0.05, 0.08, 0.12])
            texts.append(" ".join(f"x{r.random()}" if r.random() < rate else w for w in base))
    return list(enumerate(texts))


def plain(rows, width):
    sets = {}
    for i, text in rows:
        w = text.split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


@pytest.mark.parametrize("block,sample", [(1024, 256), (7, 256), (7, 40)])
def test_groups_of_near_copies(spark, monkeypatch, block, sample):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SAMPLE", sample)
    monkeypatch.setattr(minhash, "PAIRS_AT_ONCE", 100)
    rows = groups(block + sample, 40)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain(rows, 2)
    assert {r.doc_id: r.component_id for r in found} == want
    assert 4 < len(set(want.values())) < len(rows)


def test_halves_rule_out_no_link(spark):
    """Digests of one set that coincide in their lower halves count as if they were common."""
    high = 1 << 40
    sets = spark.createDataFrame([(1, [1, 1 + high, 2, 3, 4]), (2, [1, 1 + high, 2, 3, 5 - high]), (3, [7, 8, 9])], "node long, shingles array<long>")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    for percent, links in ((66, [(1, 2)]), (90, [])):
        assert [tuple(r) for r in minhash.confirm(pairs, sets, percent).collect()] == links
        assert {(1, 2)} >= {tuple(r) for r in minhash.by_halves(pairs, sets, percent).collect()} >= set(links)


def test_signatures_and_sets_move_once(spark, monkeypatch):
    """Signatures join rows that are dealt already; of the last candidates only those between components are confirmed on."""
    seen, confirm, blocks = [], minhash.confirm, minhash.in_blocks

    def counted(pairs, sets, percent):
        seen.append({tuple(r) for r in pairs.collect()})
        return confirm(pairs, sets, percent)

    def slim(posted):
        assert "signature" not in posted.columns
        return blocks(posted)

    monkeypatch.setattr(minhash, "confirm", counted)
    monkeypatch.setattr(minhash, "in_blocks", slim)
    rows = groups(3, 40)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == plain(rows, 2)
    _, likely, *rest = seen
    assert likely and len(likely) <= len(rows) and not any(likely & r for r in rest)


def test_pairs_that_are_not_the_likeliest(spark, monkeypatch):
    monkeypatch.setattr(minhash, "likeliest", lambda pairs: pairs.select("a", "b").filter("false"))
    rows = groups(5, 40)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == plain(rows, 2)


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch_path", lambda _, name: f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}-{random.random()}")
    minhash.near_duplicates(spark.createDataFrame(groups(1, 10), "doc_id long, text string")).count()
    left = sorted(p.name.rsplit("-", 2)[0] for p in tmp_path.iterdir())
    assert left == ["labels", "labels", "minhash-links", "minhash-links", "minhash-rows"]
