"""Trends of dispersion against a plain fit, the transform, and a trend that is applied to another table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyseq.operators import counts, stabilize, stats


def plain_trend(mean, disp):
    a, b = 0.1, 1.0
    keep = disp > 1e-6
    x, y = 1 / mean[keep], disp[keep]
    for _ in range(20):
        share = y / (a + b * x)
        at = (share > 1e-4) & (share < 15)
        old, c = (a, b), np.array([a, b])
        for _ in range(100):
            design = np.stack([np.ones(at.sum()), x[at]], axis=1)
            w = 1 / (design @ c) ** 2
            c = np.linalg.solve(design.T @ (w[:, None] * design), design.T @ (w * y[at]))
        a, b = c
        if np.log(a / old[0]) ** 2 + np.log(b / old[1]) ** 2 < 1e-6:
            break
    return a, b


@pytest.fixture(scope="module")
def tables(spark):
    dice = np.random.default_rng(2)
    mean = 10 ** dice.uniform(0.5, 3.5, 400)
    phi = (0.05 + 3 / mean) * dice.gamma(8, 1 / 8, 400)
    out = []
    for shift in (1.0, 1.7):
        size = 1 / phi[:, None]
        mu = mean[:, None] * dice.uniform(0.6, 1.6, 8) * shift
        own = dice.negative_binomial(size, size / (size + mu))
        rows = [(f"s{s}", f"f{f}", int(own[f, s])) for f in range(400) for s in range(8) if own[f, s]]
        out.append(spark.createDataFrame(rows, "sample string, feature string, n long"))
    return out


def test_trend_equals_a_plain_fit(tables):
    rows = stabilize.dispersions(tables[0], tables[0].select("sample").distinct().withColumn("batch", F.lit("one")))
    told = rows.toPandas()
    trend = stabilize.fit_trend(rows)
    a, b = plain_trend(told["mean"].to_numpy(), told["dispersion"].to_numpy())
    assert abs(trend.floor / a - 1) < 1e-5 and abs(trend.slope / b - 1) < 1e-5
    assert 0.03 < trend.floor < 0.08 and 1.5 < trend.slope < 5


@pytest.mark.parametrize("together", [False, True])
def test_tables_on_one_scale(tables, together):
    """Values of features spread alike whatever their mean, and each table has all its cells."""
    got = stabilize.map_onto(*tables, together=together).toPandas()
    assert len(got) == sum(t.select("feature").distinct().count() * 8 for t in tables) if not together else len(got) == 16 * got["feature"].nunique()
    spread = got.groupby(["table", "feature"])["value"].agg(["mean", "std"]).reset_index()
    low, high = (spread[(spread["mean"] > a) & (spread["mean"] <= b)]["std"].mean() for a, b in ((5, 7.5), (9, 13)))
    assert 0.6 < low / high < 1.7


def test_no_trend(spark):
    rows = spark.createDataFrame([("f", 3.0, 0.2)], "feature string, mean double, dispersion double")
    for some in (rows, rows.limit(0)):
        with pytest.raises(ValueError, match="too few"):
            stabilize.fit_trend(some)


def test_quantiles_of_many_ties(spark):
    dice = np.random.default_rng(1)
    x = dice.integers(0, 4, (50, 3)).astype(float)
    values = spark.createDataFrame([(f"s{s}", f"f{f:02d}", float(x[f, s])) for f in range(50) for s in range(3)], "sample string, feature string, value double")
    got = {(r["sample"], r.feature): r.value for r in stats.quantile_normalize(values).collect()}
    means = np.sort(x, axis=0).mean(axis=1)
    for s in range(3):
        ranks = np.argsort(np.argsort(x[:, s], kind="stable"), kind="stable")
        for f in range(50):
            assert abs(got[f"s{s}", f"f{f:02d}"] - means[ranks[x[:, s] == x[f, s]]].mean()) < 1e-12


def test_groups_take_one_shuffle(spark):
    rows = spark.createDataFrame([("s", "g", "u", 1), ("s", "g", "u", 2), ("s", None, "u", 3), ("t", "g", "v", 4)], "sample string, gene string, umi string, n int")
    found = counts.group_umis(rows)
    assert sorted((r.n, r.umi_count) for r in found.collect()) == [(1, 2), (2, 2), (4, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.find("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "ENSURE_REQUIREMENTS" not in final
