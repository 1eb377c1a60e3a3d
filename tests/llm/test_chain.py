"""Marginals of chains against the sum over all labellings."""

from itertools import product

import numpy as np
import pytest

from voltdrift.llm.chain import chains, marginals


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_marginals_match_enumeration(block):
    rng = np.random.default_rng(block)
    lengths, labels = [1, 5, 2, 7, 4], 3
    scores, moves = rng.normal(size=(sum(lengths), labels)) * 3, rng.normal(size=(labels, labels))
    found, pairs, normal = marginals(scores, moves, chains(np.array(lengths), block), pairs=True)
    expected, expected_pairs, total, at = np.zeros_like(found), np.zeros_like(pairs), 0.0, 0
    for n in lengths:
        paths = list(product(range(labels), repeat=n))
        weights = np.exp(
            [sum(scores[at + i, y[i]] for i in range(n)) + sum(moves[y[i], y[i + 1]] for i in range(n - 1)) for y in paths]
        )
        total += np.log(weights.sum())
        for y, w in zip(paths, weights / weights.sum(), strict=True):
            for i in range(n):
                expected[at + i, y[i]] += w
            for i in range(n - 1):
                expected_pairs[y[i], y[i + 1]] += w
        at += n
    assert np.allclose(found, expected) and np.allclose(pairs, expected_pairs) and np.isclose(normal, total)


def test_no_chains():
    assert marginals(np.zeros((0, 2)), np.zeros((2, 2)), chains(np.zeros(0))).shape == (0, 2)
