"""Distribution and quantiles of the negative binomial against exact sums."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyseq.functions import negbin


def pmf(most, mu, phi):
    k, size = np.arange(most + 1), 1 / phi
    log_choose = np.concatenate([[0.0], np.cumsum(np.log((size + k[:-1]) / (k[:-1] + 1)))])
    return np.exp(log_choose + k * math.log(phi * mu / (1 + phi * mu)) - size * math.log1p(phi * mu))


def test_equal_to_sums():
    """100,000 arguments: 500 pairs of mean and dispersion, 200 counts and quantiles each."""
    dice = np.random.default_rng(3)
    for mu, phi in zip(10 ** dice.uniform(-3, 3, 500), 10 ** dice.uniform(-4, 1, 500), strict=True):
        most = int(mu + 12 * math.sqrt(mu + phi * mu * mu) + 40)
        exact = np.minimum(np.cumsum(pmf(most, mu, phi)), 1)
        k = dice.integers(0, most + 1, 200)
        assert np.abs(negbin.cdf(k, mu, phi) - exact[k]).max() < 1e-9
        p = dice.uniform(0, min(exact[-1], 1 - 1e-9), 200)
        want = np.searchsorted(exact, p)
        got = negbin.quantile(p, mu, phi)
        near = np.abs(exact[np.minimum(want, most)] - p) < 1e-9
        assert np.all((got == want) | near | ((want > 0) & (np.abs(exact[want - 1] - p) < 1e-9)))


def test_edges():
    assert negbin.cdf(-1, 2.0, 0.5) == 0 and negbin.cdf(0, 0.0, 0.5) == 1
    assert negbin.quantile(np.array([0.0, 0.3]), 5.0, 0.1)[0] == 0
    far = np.array([10**6])
    assert negbin.match(far, np.array([1.0]), np.array([0.1]), np.array([2.0]), np.array([0.1]), False) == far


@pytest.mark.parametrize("keep_zero", [False, True])
def test_matching(spark, keep_zero):
    dice = np.random.default_rng(8)
    rows = [(int(n), float(a), float(b), float(c), float(d)) for n, a, b, c, d in zip(dice.integers(0, 60, 300), 10 ** dice.uniform(0, 2, 300), 10 ** dice.uniform(-2, 0, 300), 10 ** dice.uniform(0, 2, 300), 10 ** dice.uniform(-2, 0, 300), strict=True)]

    def one(n, mu, phi, new_mu, new_phi):
        if keep_zero and n <= 1:
            return n
        p = math.fsum(pmf(n - keep_zero, mu, phi))
        if abs(p - 1) < (1e-4 if keep_zero else 1e-6):
            return n
        return int(np.searchsorted(np.cumsum(pmf(20_000, new_mu, new_phi)), p * (1 - 1e-13))) + keep_zero

    df = spark.createDataFrame(rows, "n long, a double, b double, c double, d double")
    got = df.select("n", "a", negbin.matched(*[F.col(c) for c in "nabcd"], keep_zero=keep_zero).alias("m")).collect()
    assert [(r.n, r.m) for r in got] == [(r[0], one(*r)) for r in rows]


def test_same_distribution_changes_nothing():
    n = np.arange(200)
    assert (negbin.match(n, np.full(200, 60.0), np.full(200, 0.2), np.full(200, 60.0), np.full(200, 0.2), False) == n).all()


def test_log_likelihood(spark):
    rows = [(n, mu, phi) for n in (0, 1, 7, 250) for mu in (0.01, 3.0, 400.0) for phi in (1e-6, 0.1, 3.0)]
    got = spark.createDataFrame(rows, "n int, mu double, phi double").select(negbin.log_likelihood(F.col("n").cast("double"), F.col("mu"), F.col("phi"))).collect()
    for (n, mu, phi), (found,) in zip(rows, got, strict=True):
        want = math.log(pmf(n, mu, phi)[n]) if pmf(n, mu, phi)[n] > 1e-300 else None
        assert want is None or abs(found - want) < 1e-8 * (1 + abs(want))
