"""Nearest-neighbour pairing of samples across groups and the correction that follows from it, in long form (sample, feature, value)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallyseq.functions.negbin import incomplete_beta
from tallyseq.operators.counts import complete, log2_cpm
from tallyseq.operators.stats import adjust_fdr, quantile_normalize, reverse_log2_cpm, top_deviating
from tallyseq.session import materialize

#: Samples of a block of products.
BLOCK = 256
#: Features that correlations are taken over, at most; a sample's values of these are one row.
MOST_FEATURES = 5000


def profiles(values: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """Each sample's unit vector ``v`` over the ``top`` most deviating features, after the means of features and of their groups are taken away.

    A constant profile has no direction: its vector is null, and it correlates 0 with all others.
    """
    kept = values.join(F.broadcast(top_deviating(values, top).select("feature")), "feature").join(groups, "sample")
    means = kept.groupBy("feature", "group").agg(F.avg("value").alias("mean"))
    centred = kept.join(means, ["feature", "group"]).select("sample", "group", "feature", (F.col("value") - F.col("mean")).alias("x"))
    listed = centred.groupBy("sample", "group").agg(F.transform(F.array_sort(F.collect_list(F.struct("feature", "x"))), lambda c: c.x).alias("x"))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, b: a + b)
    moved = listed.withColumn("mean", total(F.col("x")) / F.size("x")).withColumn("x", F.transform("x", lambda c: c - F.col("mean")))
    length = F.sqrt(total(F.transform("x", lambda c: c * c)))
    return moved.select("sample", "group", F.when(length > 1e-12, F.transform("x", lambda c: c / length)).alias("v"))


def nearest(values: DataFrame, groups: DataFrame, k: int = 1, top: int = 2000, block: int = BLOCK) -> DataFrame:
    """For each sample and group the ``k`` samples of the group that correlate most (sample, group, place from 1, match).

    Place 1 of a sample's own group is the sample itself. Equal correlations go by name; a group with fewer samples gives all it has.
    Samples are cut into blocks; two blocks meet in a task, which keeps ``k`` matches for each sample and group, and the
    best of all blocks are merged. No table of all pairs is made.
    """
    if top > MOST_FEATURES:
        raise ValueError(f"correlations are taken over {MOST_FEATURES} features at most")
    rows = materialize(profiles(values, groups, top))
    blocks = max(1, -(-rows.count() // block))
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("sample"), F.lit(blocks)))
    left = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).select("own", "with", F.lit(True).alias("asks"), "sample", "group", "v")
    right = dealt.withColumn("asking", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).select(F.col("asking").alias("own"), F.col("own").alias("with"), F.lit(False).alias("asks"), "sample", "group", "v")

    def best(tile: pd.DataFrame) -> pd.DataFrame:
        asks, told = tile[tile["asks"]], tile[~tile["asks"]].sort_values("sample")
        if not len(asks) or not len(told):
            return pd.DataFrame({"sample": [], "group": [], "match": [], "cor": []}).astype({"cor": float})
        dim = max([len(v) for v in tile["v"] if v is not None], default=1)
        stack = lambda part: np.stack([np.zeros(dim) if v is None else np.asarray(v, float) for v in part["v"]])
        cor = np.round(stack(asks) @ stack(told).T, 12)
        out = []
        for group, at in told.reset_index().groupby("group").indices.items():
            order = np.argsort(-cor[:, at], axis=1, kind="stable")[:, : k + 1]
            out.append(pd.DataFrame({"sample": np.repeat(asks["sample"].to_numpy(), order.shape[1]), "group": group, "match": told["sample"].to_numpy()[at[order]].ravel(), "cor": np.take_along_axis(cor[:, at], order, 1).ravel()}))
        return pd.concat(out)

    found = left.unionByName(right).groupBy("own", "with").applyInPandas(best, "sample string, group string, match string, cor double")
    merged = found.join(rows.select("sample", F.col("group").alias("home")), "sample")
    rank = F.struct((~((F.col("group") == F.col("home")) & (F.col("sample") == F.col("match")))).alias("other"), (-F.col("cor")).alias("far"), F.col("match").alias("match"))
    few = merged.groupBy("sample", "group").agg(F.slice(F.array_sort(F.collect_list(rank)), 1, k).alias("some"))
    # the own group's first place is the sample, at whatever distance
    return few.select("sample", "group", F.posexplode("some").alias("place", "m")).select("sample", "group", (F.col("place") + 1).alias("place"), F.col("m.match").alias("match"))


def pair_corrected(values: DataFrame, pairs: DataFrame) -> DataFrame:
    """Values without what sets the pairs apart: a sample's value less the mean of its pairs' means, plus the feature's mean.

    ``pairs`` are the matches of ``nearest``, the same number for each group, so that a pair's effect is its plain mean.
    """
    matched = pairs.select(F.col("sample").alias("pair"), "match")
    met = matched.join(values.withColumnRenamed("sample", "match"), "match")
    effects = met.groupBy("feature", "pair").agg(F.avg("value").alias("effect"))
    of_sample = matched.join(effects, "pair").groupBy("feature", F.col("match").alias("sample")).agg(F.avg("effect").alias("effect"))
    moved = values.join(of_sample, ["feature", "sample"]).select("sample", "feature", "value", (F.col("value") - F.col("effect")).alias("moved"))
    means = moved.groupBy("feature").agg((F.avg("value") - F.avg("moved")).alias("back"))
    return moved.join(means, "feature").select("sample", "feature", (F.col("moved") + F.col("back")).alias("value"))


def t_tail(t: Column, df: Column) -> Column:
    """Two-sided tail probability of Student's t."""

    @pandas_udf("double")
    def told(t: pd.Series, df: pd.Series) -> pd.Series:
        t, df = t.to_numpy(float), df.to_numpy(float)
        known = np.isfinite(t) & (df > 0)
        x = np.where(known, df / (df + t * t), 0.5)
        p = incomplete_beta(x, np.where(known, df / 2, 1.0), np.full(len(t), 0.5))
        return pd.Series(np.where(known, p, np.where(np.isinf(t) & (df > 0), 0.0, np.nan)))

    return told(t, df)


def regress_groups(values: DataFrame, groups: DataFrame) -> DataFrame:
    """Per feature the p-value of the second group's coefficient in a regression on groups, and its adjusted value (feature, t, p, q).

    Groups are in order of their names and the first is the base. Least squares follow from each feature's number, sum and sum of squares
    per group, so no feature is gathered. A feature without spread inside groups has t infinite and p 0, one without any spread none.
    """
    names = [r[0] for r in groups.select("group").distinct().orderBy("group").limit(2).collect()]
    if len(names) < 2:
        raise ValueError("two groups are needed")
    sums = values.join(groups, "sample").groupBy("feature", "group").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("spread"))
    of = lambda c, g: F.max(F.when(F.col("group") == g, F.col(c)))
    fit = sums.groupBy("feature").agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("spread")).alias("rss"), *[of(c, g).alias(f"{c}{i}") for c in ("n", "mean") for i, g in enumerate(names)])
    df = F.col("n") - F.col("k")
    error = F.sqrt(F.col("rss") / df * (1 / F.col("n0") + 1 / F.col("n1")))
    gap = F.col("mean1") - F.col("mean0")
    t = F.when(error > 1e-14, gap / error).when(F.abs(gap) > 1e-14, F.signum(gap) * float("inf"))
    told = fit.where((df > 0) & F.col("n0").isNotNull() & F.col("n1").isNotNull()).select("feature", t.alias("t"), df.alias("df")).where("t is not null")
    return adjust_fdr(told.select("feature", "t", t_tail(F.col("t"), F.col("df")).alias("p"), F.lit("").alias("family")), "family", "p", "feature").drop("family")


def match_groups(counts: DataFrame, groups: DataFrame, top: int = MOST_FEATURES, reverse: bool = False) -> DataFrame:
    """From counts to corrected values: log2 counts per million, quantile normalisation, pairing over ``top`` features, correction.

    With ``reverse`` the values go back to counts (sample, feature, n) at each sample's own depth. Negative counts, and samples
    without a group, raise.
    """
    checked = counts.withColumn("n", F.when(F.col("n") >= 0, F.col("n")).otherwise(F.raise_error(F.concat(F.lit("a count below 0: "), F.col("feature"))).cast("long")))
    if lost := checked.join(groups, "sample", "left_anti").select("sample").first():
        raise ValueError(f"a sample without a group: {lost[0]}")
    values = quantile_normalize(log2_cpm(complete(checked, checked.select("sample"))))
    found = pair_corrected(values, nearest(values, groups, 1, top))
    return reverse_log2_cpm(found, checked) if reverse else found


def differential_features(counts: DataFrame, groups: DataFrame, top: int = MOST_FEATURES) -> DataFrame:
    """P-values of the second group's coefficient on corrected values, and their adjusted ones (feature, t, p, q)."""
    return regress_groups(match_groups(counts, groups, top), groups)
