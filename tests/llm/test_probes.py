"""Cases that once crashed or gave uneven or wrong results."""

import random

import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from turnstile.llm import packing, phrases, sharding, tokens

DOCS = "doc_id long, text string"
CASES = {
    "null rows beside ids": [(None, None)] * 40 + [(i, f"text {i}") for i in range(20)],
    "copies without id": [(None, "same text")] * 80 + [(i, f"other {i}") for i in range(80)],
    "wide ids": [(s * (2**63 - 1 - i), "one text for all") for i in range(40) for s in (1, -1)],
    "no ids": [(None, "same text")] * 80 + [(None, f"text {i:04}") for i in range(80)],
    "one row often": [(5, "same text")] * 100,
    "least and greatest id": [(-(2**63), "a"), (2**63 - 1, "a"), (None, "a"), (0, "a")] * 10,
}


@pytest.mark.parametrize("name", CASES)
def test_shards_of_ties(spark, name):
    rows = CASES[name]
    found = sharding.shard_report(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.size) for r in found if r.doc_id is not None) == sorted((i, len((t or "").encode()) + 1) for i, t in rows if i is not None)
    assert len(found) == len(rows)
    loads = {k: [r for r in found if r["shard"] == k] for k in range(8)}
    for inside in loads.values():
        assert sorted(r.slot for r in inside) == list(range(len(inside)))
    sizes = [sum(r.size for r in inside) for inside in loads.values()]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in found)


def test_texts_without_id_that_share_a_short_hash(spark):
    words = " ".join(f"w{i}" for i in range(30))
    texts = spark.range(400_000).select(F.concat(F.lit(words + " "), F.col("id").cast("string")).alias("text"))
    pair = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).where("size(t) > 1").first()["t"][:2]
    other = " ".join(f"v{i}" for i in range(50))
    rows = [(None, pair[0]), (None, pair[1]), (None, other), (1, other), (2, pair[0])]
    found = phrases.without_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert sum(r.n_removed for r in found if r.n_words == 50) == 50
    # Two of the three texts of 31 words share all but the last word with an earlier one, and one is a whole copy.
    assert sorted(r.n_removed for r in found if r.n_words == 31) == [0, 30, 31]


@pytest.mark.parametrize("name,make", [("byte_bpe_50k.json", tokens.byte_bpe), ("word_bpe_49k.json", tokens.word_bpe)])
def test_names_of_special_tokens(name, make):
    """Ids are those of the library's own call, also where a text holds the name of a special token."""
    library = Tokenizer.from_file(public_tokenizers.path(name))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y $ z", "<|ENDOFTEXT|> <|endoftext|", "plain words, again", None, ""]
    encoder = make()
    found = [ids[b:e].tolist() for ids, bounds in encoder.encode(pa.array(texts, pa.string())) for b, e in zip(bounds[:-1], bounds[1:])]
    assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_lowest_cost_with_room():
    """Every piece lies in the sequence of lowest cost that had room for it; one is cut only where none had."""
    r = random.Random(3)
    sizes = [r.choice([r.randint(1, 200), r.randint(500, 4095), 4096, 9000]) for _ in range(900)]
    placed = packing.pack(sizes)
    rest = [p for p in placed if p[2] < 4096]
    first = min(p[3] for p in rest)
    room, cost = {}, {}
    for s in range(first, max(p[3] for p in placed) + 1):
        room[s], cost[s] = 4096, 0.0
    for doc, start, length, s, offset in rest:
        assert offset == 4096 - room[s] and length <= room[s]
        whole = (sizes[doc] - start) % 4096 or 4096
        able = [q for q in room if room[q] >= whole]
        if able:
            assert length == whole and cost[s] == min(cost[q] for q in able)
        else:
            assert room[s] == max(room.values()) == length
        room[s] -= length
        cost[s] += packing.attention_cost(length)
    assert sum(room.values()) < 4096 and sum(p[2] for p in placed) == sum(sizes)
