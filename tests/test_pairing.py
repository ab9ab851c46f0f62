"""Pairing, its correction, regression and draws against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyseq.operators import counts, draws, pairing


def plain_nearest(x, groups, k, top):
    """x: features x samples."""
    names = [f"s{i:02d}" for i in range(x.shape[1])]
    keep = sorted(sorted(range(len(x)), key=lambda f: (-np.std(x[f], ddof=1), f"f{f}"))[:top])
    d = x[keep].astype(float)
    for g in set(groups):
        at = [i for i, h in enumerate(groups) if h == g]
        d[:, at] -= d[:, at].mean(axis=1, keepdims=True)
    d -= d.mean(axis=0)
    norm = np.linalg.norm(d, axis=0)
    u = np.where(norm > 1e-12, d / np.where(norm > 0, norm, 1), 0)
    cor = np.round(u.T @ u, 12)
    return sorted((names[i], g, p + 1, names[j]) for i in range(len(names)) for g in sorted(set(groups)) for p, j in enumerate(sorted([j for j in range(len(names)) if groups[j] == g], key=lambda j: (i != j, -cor[i, j], names[j]))[:k]))


@pytest.mark.parametrize(("block", "k"), [(256, 1), (5, 1), (7, 3)])
def test_nearest(spark, block, k):
    dice = np.random.default_rng(4)
    x = np.round(dice.normal(size=(30, 23)) + dice.normal(size=(30, 1)) * 2, 3)
    x[:, 5] = x[:, 6]  # equal samples
    groups = [f"g{i % 3}" for i in range(23)]
    values = spark.createDataFrame([(f"s{s:02d}", f"f{f}", float(x[f, s])) for f in range(30) for s in range(23)], "sample string, feature string, value double")
    of = spark.createDataFrame([(f"s{s:02d}", g) for s, g in enumerate(groups)], "sample string, group string")
    got = pairing.nearest(values, of, k, 12, block)
    assert sorted(tuple(r) for r in got.collect()) == plain_nearest(x, groups, k, 12)
    if k == 1:
        pairs = {(r["sample"], r.group): int(r.match[1:]) for r in got.collect()}
        b = [[pairs[f"s{p:02d}", g] for g in ("g0", "g1", "g2")] for p in range(23)]
        full = np.array([[x[:, s] for s in row] for row in b])  # pair, group, feature
        moved = full - full.mean(axis=1, keepdims=True) + full.mean(axis=(0, 1))
        out = np.stack([np.mean([moved[p, g] for p in range(23) for g in range(3) if b[p][g] == s], axis=0) for s in range(23)], axis=1)
        out += (x.mean(axis=1) - out.mean(axis=1))[:, None]
        told = {(r["sample"], r.feature): r.value for r in pairing.pair_corrected(values, got).collect()}
        assert len(told) == x.size and all(abs(told[f"s{s:02d}", f"f{f}"] - out[f, s]) < 1e-9 for f in range(30) for s in range(23))


def test_t_tail(spark):
    """Against the integral of the density."""
    rows = [(t, df) for t in (0.0, 0.3, -2.5, 8.0) for df in (1, 2, 5, 40)]
    got = spark.createDataFrame(rows, "t double, df int").select(pairing.t_tail(F.col("t"), F.col("df").cast("double")).alias("p")).collect()
    for (t, df), r in zip(rows, got, strict=True):
        angle = np.linspace(0, math.atan(abs(t) / math.sqrt(df)), 200_001)  # t = sqrt(df) tan(angle)
        y = np.cos(angle) ** (df - 1)
        area = float(((y[1:] + y[:-1]) / 2).sum() * (angle[1] - angle[0])) if t else 0.0
        want = 1 - 2 * area * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)
        assert abs(r.p - want) < 1e-8


def test_regression_of_odd_features(spark):
    rows = [(f"s{i}", "flat", 2.0) for i in range(6)] + [(f"s{i}", "step", float(i // 3)) for i in range(6)] + [(f"s{i}", "line", float(i * i)) for i in range(6)]
    values = spark.createDataFrame(rows, "sample string, feature string, value double")
    groups = spark.createDataFrame([(f"s{i}", f"g{i // 3}") for i in range(6)], "sample string, group string")
    got = {r.feature: r for r in pairing.regress_groups(values, groups).collect()}
    assert set(got) == {"step", "line"} and got["step"].p == 0 and math.isinf(got["step"].t)
    x, y = np.array([0, 0, 0, 1, 1, 1]), np.arange(6) ** 2.0
    slope = np.polyfit(x, y, 1)
    error = math.sqrt(((y - np.polyval(slope, x)) ** 2).sum() / 4 / ((x - 0.5) ** 2).sum())
    assert abs(got["line"].t - slope[0] / error) < 1e-9 and got["line"].q >= got["line"].p
    with pytest.raises(ValueError, match="two groups"):
        pairing.regress_groups(values, groups.withColumn("group", F.lit("one")))


def test_hypergeometric_of_large_numbers():
    dice = np.random.default_rng(6)
    good, bad, n = 3 * 10**9, 9 * 10**9, 10**9
    got = np.array([draws.hypergeometric(good, bad, n, dice) for _ in range(300)])
    mean, sd = n / 4, math.sqrt(n * 0.25 * 0.75 * (1 - n / (good + bad)))
    assert abs(got.mean() - mean) < 4 * sd / math.sqrt(300) and 0.85 < got.std() / sd < 1.15
    assert draws.hypergeometric(2, 2 * 10**9, 2 * 10**9 + 1, dice) in (1, 2)
    assert draws.hypergeometric(5 * 10**9, 0, 7, dice) == 7 and draws.hypergeometric(0, 5 * 10**9, 7, dice) == 0


@pytest.mark.parametrize("fan", [256, 4])
def test_draws(spark, monkeypatch, fan):
    """Whole totals, no cell above its own, means and variances of the distribution, the same in each run; also over several levels."""
    monkeypatch.setattr(draws, "FAN", fan)
    own = {"a": {f"f{i}": 1 + i * i for i in range(40)}, "b": {"f1": 5, "f2": 0}, "c": {"f1": 10**12, "f2": 3 * 10**12}}
    rows = spark.createDataFrame([(s, f, n) for s, c in own.items() for f, n in c.items()], "sample string, feature string, n long")
    plan = spark.createDataFrame([(f"a{i}", "a", 2000) for i in range(200)] + [("b0", "b", 5), ("b1", "b", 3), ("b2", "b", 0), ("c0", "c", 10**9), ("d0", "d", 3)], "sample string, original_sample string, target long")
    found = draws.draw_samples(rows, plan)
    got = {}
    for r in found.collect():
        got.setdefault(r["sample"], {})[r.feature] = r.n
    assert sorted(map(tuple, found.repartition(3).collect())) == sorted((s, f, n) for s, c in got.items() for f, n in c.items())
    assert got["b0"] == {"f1": 5} and got["b1"] == {"f1": 3} and not {"b2", "d0"} & set(got) and sum(got["c0"].values()) == 10**9
    total = sum(own["a"].values())
    for f, n in own["a"].items():
        some = np.array([got[f"a{i}"].get(f, 0) for i in range(200)])
        assert some.max() <= n
        mean, var = 2000 * n / total, 2000 * (n / total) * (1 - n / total) * (total - 2000) / (total - 1)
        assert abs(some.mean() - mean) < 5 * math.sqrt(var / 200) and (var < 1 or 0.6 < some.var() / var < 1.6)
    assert all(sum(got[f"a{i}"].values()) == 2000 for i in range(200))


def test_plan_and_draw(spark):
    rows = spark.createDataFrame([("a", "x", 50), ("a", "y", 50), ("b", "x", 30), ("c", "y", 7)], "sample string, feature string, n long")
    metadata = spark.createDataFrame([("a", "b", 1), ("b", "10", 2), ("c", None, 3)], "sample string, to string, age int")
    plan = counts.rarefaction_plan(rows, metadata, 2, key="to")
    got = {r["sample"]: r.n for r in draws.draw_samples(rows, plan).groupBy("sample").agg(F.sum("n").alias("n")).collect()}
    assert got == {"a_rarefied_0": 30, "a_rarefied_1": 30, "b_rarefied_0": 10, "b_rarefied_1": 10, "c_rarefied_0": 6, "c_rarefied_1": 6}
