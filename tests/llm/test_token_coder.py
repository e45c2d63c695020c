"""Token files: room taken by coded ids, and words looked up across slices."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from turnstile.llm import range_coder, tokens


def encoded(encoder, texts):
    return [ids[b:e].tolist() for ids, bounds in encoder.encode(pa.array(texts, pa.string())) for b, e in zip(bounds[:-1], bounds[1:])]


def test_less_room_than_plain_entropy():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].combine_chunks()
    ids = np.concatenate([ids for ids, _ in tokens.byte_bpe().encode(texts)])
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    blocks, sums = range_coder.encode_segment(ids)
    assert sum(map(len, blocks)) * 8 < -(share * np.log2(share)).sum() * len(ids)
    assert (range_coder.decode_segment(blocks, sums, len(ids)) == ids).all()


def test_words_seen_before_and_line_ends():
    encoder = tokens.byte_bpe()
    rounds = [
        ["foo bar", "foo", None, ""],
        ["foo, foo", "x foo,", "baz, baz", "foo,\nfoo bar.\nBar"],
        ["a\n\n\nb c", "a \nb", "a\t\nb", "a\n b", "a\n\nb", "end\n\n", "end\n", "\n", "\nfoo", "a\t b", "a\n\n b"],
        ["don't,' stop%%%", "Ünïcode's##, x's, 12,\n34", "x\n中文,\ny→,\nz", "a\r\nb", "foo, foo\nfoo"],
    ]
    for texts in rounds + rounds[::-1]:
        assert encoded(encoder, texts) == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_frequent_and_all_ids():
    for ids in (np.full(5000, 65535), np.arange(65536), np.repeat([3, 7], [9000, 1]), np.tile(np.arange(300), 60)):
        ids = ids.astype("<u2")
        blocks, sums = range_coder.encode_segment(ids, 700)
        assert (range_coder.decode_segment(blocks, sums, len(ids), 700) == ids).all()
