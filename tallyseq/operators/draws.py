"""Random draws from count tables without replacement, without a row per molecule.

The molecules of a sample lie in ranges of features. How many of a draw fall into each range follows a multivariate
hypergeometric distribution, and within a range the same holds of its parts: so a draw is split over ``FAN`` ranges, each share
again over its parts, until a part holds few features. The result has the distribution of drawing molecules one by one.
Each split is seeded by the draw and the range, so runs agree whatever the partitions are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyseq.session import materialize

#: Parts of a range.
FAN = 256
#: Numbers up to which the generator's own hypergeometric draws work.
PLAIN = 10**9


def hypergeometric(good: int, bad: int, draws: int, dice: np.random.Generator) -> int:
    """Good ones among ``draws`` of ``good + bad``, also for numbers beyond ``PLAIN``: the probabilities around the mode, inverted."""
    if good + bad < PLAIN:
        return int(dice.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(good, draws)
    total = good + bad
    spread = (draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    near = int(14 * spread) + 60
    first, last = max(low, mode - near), min(high, mode + near)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log((good - k) / (k + 1)) + np.log((draws - k) / (bad - draws + k + 1))
    log_p = np.concatenate([[0.0], np.cumsum(steps)])
    p = np.cumsum(np.exp(log_p - log_p.max()))
    return first + int(np.searchsorted(p, dice.random() * p[-1], side="right"))


def split_draw(sizes: np.ndarray, draws: int, key: str) -> np.ndarray:
    """How many of ``draws`` fall into each of the parts."""
    dice = np.random.default_rng(int.from_bytes(hashlib.blake2b(key.encode(), digest_size=16).digest(), "little"))
    if sizes.sum() < PLAIN:
        return dice.multivariate_hypergeometric(sizes, draws, method="marginals")
    out, rest, left = np.zeros(len(sizes), np.int64), int(sizes.sum()), int(draws)
    for i, n in enumerate(sizes.tolist()):
        rest -= n
        out[i] = hypergeometric(n, rest, left, dice) if left else 0
        left -= int(out[i])
    return out


def _split(seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for sample, original, place, take, parts, sizes in zip(*[rows[c] for c in ("sample", "original_sample", "place", "take", "parts", "sizes")], strict=True):
                sizes = np.asarray(sizes, np.int64)
                got = split_draw(sizes, int(take), f"{seed}\0{sample}\0{place}")
                some = np.flatnonzero(got)
                out.append(pd.DataFrame({"sample": sample, "original_sample": original, "part": np.asarray(parts, object)[some], "take": got[some]}))
            if out:
                yield pd.concat(out)

    return run


def draw_samples(counts: DataFrame, plan: DataFrame, seed: int = 42) -> DataFrame:
    """Counts (sample, feature, n) of the samples of ``plan`` (sample, original_sample, target), as ``rarefaction_plan`` names them.

    Each is a draw of ``target`` molecules of its original without replacement; a target of no less than the total gives the original
    whole. Negative targets give nothing. ``counts``: sample, feature, n; cells of no count are left out.
    """
    cells = counts.where("n > 0").select(F.col("sample").alias("original_sample"), "feature", F.col("n").cast("long").alias("n"))
    totals = cells.groupBy("original_sample").agg(F.sum("n").alias("own"), F.count("*").alias("cells"))
    named = materialize(plan.select("sample", "original_sample", F.col("target").cast("long").alias("target")).join(totals, "original_sample"))
    whole = named.where("target >= own").select("sample", "original_sample").join(cells, "original_sample").select("sample", "feature", "n")
    drawn = named.where("target < own and target > 0")
    most = drawn.agg(F.max("cells")).first()[0] or 0
    levels = 0
    while most > FAN ** (levels + 1):
        levels += 1
    place = lambda depth: F.concat_ws(".", F.lit(""), *[F.pmod(F.xxhash64(F.lit(k), "feature"), F.lit(FAN)).cast("string") for k in range(depth)])
    cells = materialize(cells.join(drawn.select("original_sample").distinct(), "original_sample"))
    shares = drawn.select("sample", "original_sample", F.lit("").alias("place"), F.col("target").alias("take"))
    for depth in range(levels + 1):
        inner = F.col("feature") if depth == levels else place(depth + 1)
        parts = cells.groupBy("original_sample", place(depth).alias("place"), inner.alias("part")).agg(F.sum("n").alias("n"))
        listed = F.array_sort(F.collect_list(F.struct("part", "n")))
        parts = parts.groupBy("original_sample", "place").agg(listed.alias("all")).select("original_sample", "place", F.col("all.part").alias("parts"), F.col("all.n").alias("sizes"))
        split = shares.join(parts, ["original_sample", "place"]).select("sample", "original_sample", "place", "take", "parts", "sizes")
        shares = split.mapInPandas(_split(seed), "sample string, original_sample string, part string, take long").withColumnRenamed("part", "place")
        shares = materialize(shares)
    return whole.unionByName(shares.select("sample", F.col("place").alias("feature"), F.col("take").alias("n")))
