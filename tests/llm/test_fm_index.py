import numpy as np
import pytest

from tickloom.llm.fm_index import FmIndex, suffix_array


@pytest.mark.parametrize("seed", range(6))
def test_suffixes_are_in_order(seed):
    rng = np.random.default_rng(seed)
    text = np.append(rng.integers(1, 4, 300), 0)
    text[50:150] = text[150:250]  # a long repeat
    order = suffix_array(text, 2)
    assert [tuple(text[i:]) for i in order] == sorted(tuple(text[i:]) for i in range(len(text)))


@pytest.mark.parametrize("seed", range(6))
def test_search_and_locate_find_every_occurrence(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, 6, 500)
    text[100:200] = 3  # a long run
    patterns = np.zeros((60, 7), np.int64)
    lengths = rng.integers(1, 8, 60)
    for i, n in enumerate(lengths):
        patterns[i, :n] = rng.integers(1, 8, n) if i % 3 else text[i : i + n]
    index = FmIndex(text, 3)
    low, high = index.search(patterns, lengths)
    for i, n in enumerate(lengths):
        found = sorted(index.locate(np.arange(low[i], high[i])))
        assert found == [k for k in range(len(text) - n + 1) if (text[k : k + n] == patterns[i, :n]).all()]


def test_one_symbol():
    index = FmIndex(np.array([1]), 2)
    low, high = index.search(np.array([[1], [2]]), np.array([1, 1]))
    assert (high - low).tolist() == [1, 0]
