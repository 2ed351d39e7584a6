"""Marginals of the chain against the enumeration of all labellings."""

from itertools import product

import numpy as np
import pytest

from tenderlake.llm.crf import Chain


@pytest.mark.parametrize("seed", range(8))
def test_marginals_and_gradient_against_enumeration(seed):
    rng = np.random.default_rng(seed)
    lengths = [1, 2, 5, 7]
    chain = Chain(rng.normal(0, 1.5, 3), float(rng.normal()))
    scores = rng.normal(0, 2, (max(lengths), len(lengths)))
    mask = np.arange(max(lengths))[:, None] < np.array(lengths)
    found = chain.marginals(scores, mask)[0]
    table = {(0, 0): 0.0, **dict(zip([(0, 1), (1, 0), (1, 1)], chain.transitions))}

    def weight(path, column):
        steps = sum(table[step] for step in zip(path, path[1:]))
        return np.exp(chain.start * path[0] + steps + sum(scores[i, column] for i, y in enumerate(path) if y))

    for column, n in enumerate(lengths):
        paths = list(product((0, 1), repeat=n))
        weights = np.array([weight(p, column) for p in paths])
        want = (np.array(paths) * weights[:, None]).sum(axis=0) / weights.sum()
        assert found[:n, column] == pytest.approx(want, abs=1e-12) and (found[n:, column] == 0).all()
    labels = rng.integers(0, 2, scores.shape) * mask

    def likelihood(c):
        total = 0.0
        for column, n in enumerate(lengths):
            own = tuple(labels[:n, column])
            total += np.log(weight(own, column) / sum(weight(p, column) for p in product((0, 1), repeat=n)))
        return total

    by_transition, step = chain.gradient(scores, mask, labels)[1], 1e-6
    for i in range(3):
        base = chain.transitions[i]
        chain.transitions[i] = base + step
        table.update(zip([(0, 1), (1, 0), (1, 1)], chain.transitions))
        up = likelihood(chain)
        chain.transitions[i] = base - step
        table.update(zip([(0, 1), (1, 0), (1, 1)], chain.transitions))
        down = likelihood(chain)
        chain.transitions[i] = base
        table.update(zip([(0, 1), (1, 0), (1, 1)], chain.transitions))
        assert by_transition[i] == pytest.approx((up - down) / (2 * step), abs=1e-4)
