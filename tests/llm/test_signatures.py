"""MinHash values of many sets at once against one set and one hash function after the other."""

import numpy as np
import pytest

from assay.llm import ngram_join


@pytest.mark.parametrize("a_step", [1, 7, 100, 1 << 13])
def test_signatures_of_many_sets_equal_those_of_each(monkeypatch, a_step):
    monkeypatch.setattr(ngram_join, "SHINGLES_A_STEP", a_step)
    random = np.random.default_rng(7)
    sizes = [0, 3, 0, 0, 1, 250, 14, 7, 7, 100, 0, 2, 0]
    sets = [np.unique(random.integers(0, 2 ** 64, size, np.uint64)) for size in sizes]
    found = ngram_join.signatures(sets)
    top = np.iinfo(np.uint64).max
    for grams, row in zip(sets, found, strict=True):
        wanted = [
            (grams * factor + shift).min(initial=top)
            for factor, shift in zip(ngram_join.FACTORS, ngram_join.SHIFTS, strict=True)
        ]
        assert row.tolist() == wanted
    labels = ngram_join.labels_of(sets)
    assert labels == [label for grams in sets for label in ngram_join.labels_of([grams])]
    assert {len(label) for row in labels for label in row} == {
        ngram_join.DEPTH * ngram_join.VALUE_BYTES
    }


def test_signatures_of_nothing():
    assert ngram_join.labels_of([]) == []
    assert ngram_join.signatures([np.empty(0, np.uint64)] * 2).min() == np.iinfo(np.uint64).max
