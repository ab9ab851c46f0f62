"""Batch correction against a plain NumPy version: fits, dispersions, matching."""

import numpy as np
import pytest

from tallyseq.functions import negbin
from tallyseq.operators import batches

SAMPLES = [(f"s{i}", f"b{i % 2}", f"g{i // 5}") for i in range(10)]


def table(seed=1, features=25):
    dice = np.random.default_rng(seed)
    depth, base = dice.uniform(0.5, 2, 10), 10 ** dice.uniform(0.3, 2, features)
    batch, group = np.array([i % 2 for i in range(10)]), np.array([i // 5 for i in range(10)])
    mu = base[:, None] * depth * np.exp(np.outer(dice.normal(0, 0.6, features), batch) + np.outer(dice.normal(0, 0.5, features), group))
    size = 1 / np.where(batch, 0.3, 0.06)
    return dice.negative_binomial(size, size / (size + mu)), batch, group


def long_form(spark, counts):
    rows = [(f"s{s}", f"f{f}", int(counts[f, s])) for f in range(len(counts)) for s in range(10) if counts[f, s]]
    return spark.createDataFrame(rows, "sample string, feature string, n long")


def plain_fit(y, x, offset, phi, rounds=200):
    """Newton steps for one feature, halved until the likelihood gains."""
    told = lambda b: np.sum(y * (offset + x @ b) - (y + 1 / phi) * np.log1p(phi * np.exp(offset + x @ b)))
    beta = np.linalg.lstsq(x, np.log((y + 0.5) / np.exp(offset)), rcond=None)[0]
    for _ in range(rounds):
        mu = np.exp(offset + x @ beta)
        w = mu / (1 + phi * mu)
        step = np.linalg.solve(x.T @ (w[:, None] * x) + 1e-13 * np.eye(x.shape[1]), x.T @ ((y - mu) / (1 + phi * mu)))
        while told(beta + step) < told(beta) - 1e-12 and np.abs(step).max() > 1e-12:
            step = step / 2
        beta = beta + step
    return beta


def apl(y, offset, groups, phi):
    total = 0.0
    for row in y:
        for g in set(groups):
            at = groups == g
            own, off = row[at], offset[at]
            if not own.sum():
                total -= 0.5 * np.log(1e-10)
                continue
            mu = np.exp(off + plain_fit(own, np.ones((at.sum(), 1)), off, np.full(at.sum(), phi), 30)[0])
            size = 1 / phi
            total += np.sum(negbin._lgamma(own + size) - negbin._lgamma(np.full(at.sum(), size)) - negbin._lgamma(own + 1.0) + own * np.log(phi * mu) - (own + size) * np.log1p(phi * mu))
            total -= 0.5 * np.log(np.sum(mu / (1 + phi * mu)))
    return total


@pytest.fixture(scope="module")
def data(spark):
    counts, batch, group = table()
    counts[3, batch == 1] = 0  # a feature that one batch lacks
    counts[4, group == 1] = 0  # a group without counts
    kept = np.array([all(counts[f, batch == b].any() for b in (0, 1)) for f in range(len(counts))])
    return counts, batch, group, kept, long_form(spark, counts), spark.createDataFrame(SAMPLES, "sample string, batch string, group string")


def test_fitted_means(data):
    counts, batch, group, kept, rows, samples = data
    phi = {"b0": 0.06, "b1": 0.3}
    got = {(r["sample"], r.feature): r.mu for r in batches.fitted_means(rows, samples, phi).collect()}
    offset = np.log(counts[kept].sum(0))
    x = np.stack([group == 0, group == 1, batch == 1], axis=1).astype(float)
    assert len(got) == kept.sum() * 10
    for f in np.flatnonzero(kept):
        mu = np.exp(offset + x @ plain_fit(counts[f], x, offset, np.where(batch, 0.3, 0.06)))
        assert np.allclose([got[f"s{s}", f"f{f}"] for s in range(10)], mu, rtol=1e-5, atol=1e-6)


@pytest.fixture(scope="module")
def estimated(data):
    design = batches.design_of(data[5])
    return batches.dispersions(batches.cells_of(data[4], data[5], design), design)


def test_dispersions(data, estimated):
    counts, batch, group, kept, rows, samples = data
    got = estimated
    offset = np.log(counts[kept].sum(0))
    for b in (0, 1):
        at = batch == b
        y = counts[kept][:, at]
        y = y[y.sum(1) >= 5]
        near = [apl(y, offset[at], group[at], got[f"b{b}"] * r) for r in (0.97, 1, 1.03)]
        assert near[1] > near[0] and near[1] > near[2]
    assert got["b0"] < got["b1"]


def test_correction(data):
    counts, batch, group, kept, rows, samples = data
    phi = {"b0": 0.06, "b1": 0.3}
    got = {(r["sample"], r.feature): r.n for r in batches.correct_batches(rows, samples, phi).collect()}
    assert len(got) == counts.size
    offset = np.log(counts[kept].sum(0))
    x = np.stack([group == 0, group == 1, batch == 1], axis=1).astype(float)
    for f in range(len(counts)):
        if not kept[f]:
            assert [got[f"s{s}", f"f{f}"] for s in range(10)] == list(counts[f])
            continue
        beta = plain_fit(counts[f], x, offset, np.where(batch, 0.3, 0.06))
        mu = np.exp(offset + x @ beta)
        new = np.maximum(mu, 1e-4) * np.exp(-beta[2])
        if beta[2] < -0.2:
            new = np.minimum(new, mu[batch == 0].max())
        want = np.where(batch, negbin.match(counts[f], np.maximum(mu, 1e-4), np.full(10, 0.3), new, np.full(10, 0.06), False), counts[f])
        found = np.array([got[f"s{s}", f"f{f}"] for s in range(10)])
        assert (np.abs(found - want) <= 1).all() and (found == want).mean() >= 0.9  # a mean that differs in the tenth digit may tip a quantile


def test_estimated_end_to_end(data, estimated):
    """The batch effect goes: between corrected batches, features differ less than before."""
    counts, batch, group, kept, rows, samples = data
    got = {(r["sample"], r.feature): r.n for r in batches.correct_batches(rows, samples, estimated).collect()}
    after = np.array([[got[f"s{s}", f"f{f}"] for s in range(10)] for f in range(len(counts))])
    gap = lambda c: np.abs(np.log((c[kept][:, batch == 1].sum(1) + 1) / (c[kept][:, batch == 0].sum(1) + 1)))
    assert gap(after).mean() < 0.5 * gap(counts).mean()


def test_bad_designs(spark, data):
    rows = data[4]
    make = lambda *triples: spark.createDataFrame(triples, "sample string, batch string, group string")
    with pytest.raises(ValueError, match="two samples"):
        batches.correct_batches(rows, make(("s0", "a", "g"), ("s1", "b", "g"), ("s2", "b", "g")))
    with pytest.raises(ValueError, match="confounded"):
        batches.correct_batches(rows, make(("s0", "a", "g"), ("s1", "a", "g"), ("s2", "b", "h"), ("s3", "b", "h")))
    one = batches.correct_batches(rows, make(("s0", "a", "g"), ("s1", "a", "h")))
    assert one.count() == rows.select("feature").distinct().count() * 2
    empty = batches.correct_batches(rows.limit(0), make(("s0", "a", "g"), ("s1", "a", "g"), ("s2", "b", "g"), ("s3", "b", "g")))
    assert empty.count() == 0
