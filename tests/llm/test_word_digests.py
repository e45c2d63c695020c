"""Digests of words taken from whole Arrow columns, and scores of classes without their greatest taken off."""

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD
from turnstile.llm import pseudo_likelihood as P
from turnstile.llm.common import split_words

TEXTS = [text for _, text in ODD] + ["tail", "head tail", " a\tb\x0bc \x0c\r", "\x1c\x85 z", "y" * 65 + " " + "y" * 64, "ab" * P.SPAN + " end"]


@pytest.mark.parametrize("column", [pa.array(TEXTS), pa.array(["pad", *TEXTS, "x y"], pa.large_string()).slice(1, len(TEXTS))])
def test_digests_of_a_column(column):
    found, counts = P.text_words(column)
    split = [split_words(text) for text in TEXTS]
    assert counts.tolist() == [len(words) for words in split]
    pairs = set(zip([w for words in split for w in words], found.tolist(), strict=True))
    assert len(pairs) == len({w for w, _ in pairs}) == len({d for _, d in pairs})
    assert P.text_words(TEXTS)[0].tolist() == found.tolist()


def test_scores_of_any_size():
    weights = P.starting_weights()
    around = np.array([[1, 2, 3, 4], [2, 2, 9, P.OUTSIDE]])
    for factor in (1, 1000):
        weights["outer"] *= factor
        logs = P.forward(weights, around)[2]
        assert np.isfinite(logs).all() and np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-5)
        bound = np.abs(P.activations(weights, around)[2]).max() if factor == 1 else P.activations(weights, around)[2].max()
        assert bound <= P.SAFE
