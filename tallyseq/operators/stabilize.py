"""Variance stabilisation of count tables by a trend of dispersion over means, in long form (sample, feature, n)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.operators.counts import complete
from tallyseq.operators.stats import size_factors
from tallyseq.session import materialize

#: Fixed values of the fit: dispersions below are no evidence, and those too far from the trend are left out of it.
LEAST_DISPERSION = 1e-6
RESIDUALS = (1e-4, 15.0)
START = (0.1, 1.0)
ROUNDS, STEPS = 20, 60


@dataclass(frozen=True)
class Trend:
    """Dispersion = ``floor`` + ``slope`` / mean."""

    floor: float
    slope: float

    def transform(self, q: Column) -> Column:
        """Normalised counts on a scale of base 2 on which their variance is about constant."""
        a, b = F.lit(self.floor), F.lit(self.slope)
        return F.log2((1 + b + 2 * a * q + 2 * F.sqrt(a * q * (1 + b + a * q))) / (4 * a))


def dispersions(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Mean of normalised counts and dispersion by moments per feature; ``samples`` maps sample to ``batch``, whose means are their own.

    Only cells above zero are read: the zeros are in the numbers of samples.
    """
    factors = size_factors(counts)
    sized = samples.join(factors, "sample")
    batches = sized.groupBy("batch").agg(F.count("*").alias("samples"))
    told = sized.agg(F.avg(1 / F.col("size_factor")).alias("noise"), F.count("*").alias("every"), F.count_distinct("batch").alias("batches"))
    cells = counts.join(sized, "sample").withColumn("q", F.col("n") / F.col("size_factor"))
    sums = cells.groupBy("feature", "batch").agg(F.sum("q").alias("total"), F.sum(F.col("q") * F.col("q")).alias("squares")).join(F.broadcast(batches), "batch")
    whole = sums.groupBy("feature").agg(F.sum("total").alias("total"), F.sum(F.col("squares") - F.col("total") * F.col("total") / F.col("samples")).alias("inside"))
    rows = whole.crossJoin(F.broadcast(told)).where("every > batches and total > 0")
    mean, var = F.col("total") / F.col("every"), F.col("inside") / (F.col("every") - F.col("batches"))
    return rows.select("feature", mean.alias("mean"), ((var - F.col("noise") * mean) / (mean * mean)).alias("dispersion"))


def fit_trend(rows: DataFrame) -> Trend:
    """The trend of (mean, dispersion): a gamma regression with identity link on 1 / mean, repeated without what lies far from it.

    A step of the regression is one aggregate of five sums. Raises where the fit leaves the positive numbers or does not settle.
    """
    told = materialize(rows.where(F.col("dispersion") > LEAST_DISPERSION).select((1 / F.col("mean")).alias("x"), F.col("dispersion").alias("y")))
    floor, slope = START
    for _ in range(ROUNDS):
        share = F.col("y") / (floor + slope * F.col("x"))
        near = told.where((share > RESIDUALS[0]) & (share < RESIDUALS[1]))
        a, b = floor, slope
        for _ in range(STEPS):
            w = 1 / F.pow(a + b * F.col("x"), F.lit(2.0))
            s = near.agg(*[F.sum(w * v).alias(n) for n, v in (("w", F.lit(1.0)), ("x", F.col("x")), ("xx", F.col("x") * F.col("x")), ("y", F.col("y")), ("xy", F.col("x") * F.col("y")))]).first()
            room = s.w * s.xx - s.x * s.x if s.w else 0.0
            if not room > 1e-12 * (s.w or 0) * (s.xx or 0):
                raise ValueError("too few features for a trend")
            new = (s.xx * s.y - s.x * s.xy) / room, (s.w * s.xy - s.x * s.y) / room
            if min(new) <= 0:
                raise ValueError("the trend of dispersions is not positive")
            settled = abs(new[0] / a - 1) + abs(new[1] / b - 1) < 1e-9
            a, b = new
            if settled:
                break
        moved = math.log(a / floor) ** 2 + math.log(b / slope) ** 2
        floor, slope = a, b
        if moved < 1e-6:
            return Trend(floor, slope)
    raise ValueError("the trend of dispersions does not settle")


def stabilized(counts: DataFrame, trend: Trend) -> DataFrame:
    """Transformed values (sample, feature, value) of all cells, zeros too, under a trend that may come from another table.

    Size factors are the table's own. A sample that shares no common feature has no size factor and is left out.
    """
    factors = size_factors(counts)
    grid = complete(counts, counts.select("sample")).join(factors, "sample")
    return grid.select("sample", "feature", trend.transform(F.col("n") / F.col("size_factor")).alias("value"))


def map_onto(reference: DataFrame, query: DataFrame, together: bool = False) -> DataFrame:
    """Both tables transformed, with ``table`` reference or query: under the reference's frozen trend, or ``together`` under one of both.

    Fitted together, each table's means are its own, and size factors are those of all samples.
    """
    named = [t.select("sample", "feature", "n").withColumn("batch", F.lit(b)) for t, b in ((reference, "reference"), (query, "query"))]
    if together:
        both = named[0].unionByName(named[1]).withColumn("sample", F.concat_ws("\0", "batch", "sample"))
        trend = fit_trend(dispersions(both.drop("batch"), both.select("sample", "batch").distinct()))
        parts = F.split("sample", "\0", 2)
        return stabilized(both.drop("batch"), trend).select(parts[0].alias("table"), parts[1].alias("sample"), "feature", "value")
    trend = fit_trend(dispersions(reference, named[0].select("sample", "batch").distinct()))
    out = [stabilized(t, trend).select(F.lit(b).alias("table"), "sample", "feature", "value") for t, b in ((reference, "reference"), (query, "query"))]
    return out[0].unionByName(out[1])
