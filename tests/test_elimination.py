"""Elimination by sweeps against the definition: the greatest VIF leaves, found anew each round."""

import time

import numpy as np
import pytest

from creditloom.operators.collinearity import eliminated, inflation, swept


def plainly(corr, threshold, max_iter=0):
    left, out = list(range(len(corr))), []
    while left and not (max_iter and len(out) == max_iter):
        values = inflation(corr[np.ix_(left, left)])
        if values.max() < threshold:
            break
        out.append(left.pop(int(np.argmax(values))))
    return out


def sample(p, seed, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(4000, p)) @ (np.eye(p) + rng.normal(0, 0.35, (p, p)))
    for j in range(copies):
        x[:, -1 - j] = x[:, j] + x[:, j + 1] if j % 2 else 2 * x[:, j]
    return np.corrcoef(x.T)


@pytest.mark.parametrize("p,copies,seed", [(12, 0, 1), (30, 0, 2), (24, 5, 3), (40, 9, 4), (1, 0, 5)])
def test_same_selection(p, copies, seed):
    corr = np.atleast_2d(sample(p, seed, copies))
    for threshold, most in ((10.0, 0), (3.0, 0), (5.0, 4)):
        assert eliminated(corr, threshold, most) == plainly(corr, threshold, most)


def test_constant_columns_stay_unless_the_threshold_is_one():
    corr = sample(6, 7)
    corr[2, :] = corr[:, 2] = np.nan
    assert 2 not in eliminated(corr, 1.5) and sorted(eliminated(corr, 1.0)) == list(range(6))
    corr[0, 1] = corr[1, 0] = np.nan
    with pytest.raises(ValueError):
        eliminated(corr, 5.0)


def test_a_sweep_is_the_inverse_without_the_column():
    corr = sample(15, 8)
    rest = [i for i in range(15) if i != 4]
    assert np.allclose(swept(np.linalg.inv(corr), 4), np.linalg.inv(corr[np.ix_(rest, rest)]), rtol=1e-8)


def test_time_at_600_columns():
    """One round of the plain way needs 600 pseudo-inverses where columns depend on each other; all rounds of the sweep take less than a twentieth."""
    corr = sample(600, 9, copies=20)
    started = time.perf_counter()
    gone = eliminated(corr, 10.0)
    fast = time.perf_counter() - started
    started = time.perf_counter()
    for j in range(3):
        rest = np.delete(np.arange(600), j)
        np.linalg.pinv(corr[np.ix_(rest, rest)], hermitian=True)
    one_round = (time.perf_counter() - started) / 3 * 600
    left = np.delete(np.arange(600), gone)
    assert inflation(corr[np.ix_(left, left)]).max() < 10 and len(gone) >= 20 and fast * 20 < one_round
