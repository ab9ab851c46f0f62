"""Correction of count tables for batches by negative-binomial regression, in long form (sample, feature, n).

The mean of a cell is its sample's depth times the exponential of a batch effect plus a group effect. Regressions of all features
run at once: each round of reweighted least squares is one aggregate of the cells to sums per feature and kind of sample
(batch and group), and one solve of small systems over those sums. Dispersions come from the adjusted profile likelihood, of
which one aggregate gives a whole grid of values. No task needs the cells of a feature together.

``samples`` maps sample to ``batch`` and ``group``; both are strings. The number of kinds is part of the design and
bounded by ``MOST_KINDS``; the samples and features are not bounded.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.functions import negbin
from tallyseq.operators.counts import complete
from tallyseq.operators.stats import common_features
from tallyseq.session import materialize

MOST_KINDS = 256
#: Fixed values of the method: fourth root of the largest dispersion, least count of a feature in a batch that tells of its dispersion, least mean,
#: effect below which a new mean is held to the reference's largest.
LARGEST_ROOT = 4.0**0.25
LEAST_TOTAL = 5
LEAST_MEAN = 1e-4
HELD_BELOW = -0.2
#: Values of a grid of dispersions, grids, and steps of the fit on each.
GRID, GRIDS, STEPS = 11, 3, 4
ROUNDS = 60


@dataclass(frozen=True)
class Design:
    """Kinds of samples (batch, group), the batches and groups in order, and the number of samples of each kind."""

    kinds: tuple[tuple[str, str], ...]
    sizes: tuple[int, ...]

    @property
    def batches(self) -> list[str]:
        return sorted({b for b, _ in self.kinds})

    @property
    def groups(self) -> list[str]:
        return sorted({g for _, g in self.kinds})

    def size(self, batch: str) -> int:
        return sum(n for (b, _), n in zip(self.kinds, self.sizes, strict=True) if b == batch)

    def matrix(self, reference: str) -> np.ndarray:
        """Columns: the groups, then the batches but for the reference."""
        others = [b for b in self.batches if b != reference]
        return np.array([[float(g == x) for x in self.groups] + [float(b == x) for x in others] for b, g in self.kinds])


def design_of(samples: DataFrame) -> Design:
    """The design; raises where a batch has one sample or where groups and batches can't be told apart."""
    rows = sorted(tuple(r) for r in samples.groupBy("batch", "group").agg(F.count("*").alias("n")).limit(MOST_KINDS + 1).collect())
    if len(rows) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of samples")
    design = Design(tuple((b, g) for b, g, _ in rows), tuple(n for *_, n in rows))
    if any(design.size(b) < 2 for b in design.batches):
        raise ValueError("each batch needs two samples")
    if rows and np.linalg.matrix_rank(design.matrix(design.batches[0])) < len(design.groups) + len(design.batches) - 1:
        raise ValueError("groups and batches are confounded")
    return design


def cells_of(counts: DataFrame, samples: DataFrame, design: Design) -> DataFrame:
    """The dense cells (feature, sample, n, kind, batch, depth) of features that have a count in every batch."""
    kept = counts.join(common_features(counts, samples), "feature", "left_semi")
    depths = kept.groupBy("sample").agg(F.sum("n").alias("depth"))
    number = F.create_map(*[x for k, (b, g) in enumerate(design.kinds) for x in (F.array(F.lit(b), F.lit(g)), F.lit(k))])
    known = samples.join(depths, "sample", "left").select("sample", "batch", number[F.array("batch", "group")].alias("kind"), F.greatest(F.coalesce("depth", F.lit(0)), F.lit(1)).cast("double").alias("depth"))
    return materialize(complete(kept, samples).join(known, "sample").select("feature", "sample", F.col("n").cast("double").alias("n"), "kind", "batch", "depth"))


def _of_batch(design: Design, values: dict[str, list[float]], k: int) -> Column:
    """The k-th value of the cell's batch."""
    return F.get(F.array(*[F.lit(float(values[b][k])) for b, _ in design.kinds]), F.col("kind"))


def _profile(cells: DataFrame, design: Design, values: dict[str, list[float]], parts: dict[str, bool]) -> dict[str, list[float]]:
    """Adjusted profile log likelihood of each batch at each of its values, summed over features.

    Within a part (a batch, or a group of it) a feature has one rate, which Newton steps from its pooled rate fit for all values at once.
    """
    part = F.when(F.col("batch").isin([b for b, own in parts.items() if own]), F.col("kind")).otherwise(-1)
    number = len(next(iter(values.values())))
    rows = cells.withColumn("part", part)
    key = ["feature", "batch", "part"]
    pooled = rows.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("depth").alias("depth"))
    told = pooled.groupBy("feature", "batch").agg(F.sum("n").alias("all")).where(F.col("all") >= LEAST_TOTAL).select("feature", "batch")
    start = F.when(F.col("n") > 0, F.log(F.col("n") / F.col("depth")))  # null where the part is empty: its mean is 0
    state = materialize(pooled.join(told, ["feature", "batch"]).select(*key, F.array_repeat(start, number).alias("eta")))
    mus = [F.coalesce(F.col("depth") * F.exp(F.get("eta", F.lit(k))), F.lit(0.0)) for k in range(number)]
    phis = [_of_batch(design, values, k) for k in range(number)]
    for _ in range(STEPS):
        met = rows.join(state, key).groupBy(*key).agg(
            F.first("eta").alias("eta"),
            F.array(*[F.sum((F.col("n") - m) / (1 + p * m)) for m, p in zip(mus, phis, strict=True)]).alias("score"),
            F.array(*[F.sum(m / (1 + p * m)) for m, p in zip(mus, phis, strict=True)]).alias("weight"),
        )
        step = F.zip_with("score", "weight", lambda s, w: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s / F.greatest(w, F.lit(1e-10)))))
        state = materialize(met.select(*key, F.zip_with("eta", step, lambda e, d: e + d).alias("eta")))
    last = rows.join(state, key).groupBy(*key).agg(
        F.array(*[F.sum(negbin.log_likelihood(F.col("n"), m, p)) for m, p in zip(mus, phis, strict=True)]).alias("fit"),
        F.array(*[F.sum(m / (1 + p * m)) for m, p in zip(mus, phis, strict=True)]).alias("weight"),
    )
    adjusted = F.zip_with("fit", "weight", lambda f, w: f - 0.5 * F.log(F.greatest(w, F.lit(1e-10))))
    sums = last.select("batch", adjusted.alias("told")).groupBy("batch").agg(*[F.sum(F.get("told", F.lit(k))).alias(f"v{k}") for k in range(number)])
    return {r["batch"]: [r[f"v{k}"] for k in range(number)] for r in sums.collect()}  # one row per batch of the design


def dispersions(cells: DataFrame, design: Design) -> dict[str, float]:
    """The common dispersion of each batch, where the adjusted profile likelihood is greatest.

    Groups have their own rates where a batch has them all and more samples than groups, else they are pooled. Grids of the
    fourth root close in on the best value, and a parabola through the last three gives it. A batch without
    a feature of five counts has the least dispersion of the grid.
    """
    seen = {b: {g for x, g in design.kinds if x == b} for b in design.batches}
    parts = {b: len(seen[b]) == len(design.groups) and design.size(b) > len(design.groups) for b in design.batches}
    low, high = {b: 0.01 for b in design.batches}, {b: LARGEST_ROOT for b in design.batches}
    roots: dict[str, np.ndarray] = {}
    for _ in range(GRIDS):
        roots = {b: np.linspace(low[b], high[b], GRID) for b in design.batches}
        told = _profile(cells, design, {b: list(r**4) for b, r in roots.items()}, parts)
        for b in design.batches:
            best = int(np.argmax(told[b])) if b in told else 0
            low[b], high[b] = roots[b][max(0, best - 1)], roots[b][min(GRID - 1, best + 1)]
    found = {}
    for b in design.batches:
        x, v = roots[b], told.get(b)
        best = int(np.argmax(v)) if v else 0
        at = x[best]
        if v and 0 < best < GRID - 1 and (bend := v[best - 1] - 2 * v[best] + v[best + 1]) < 0:
            at += 0.5 * (x[1] - x[0]) * (v[best - 1] - v[best + 1]) / bend
        found[b] = float(at**4)
    return found


def fit_effects(cells: DataFrame, design: Design, phi: dict[str, float], reference: str) -> DataFrame:
    """Per feature: ``eta``, the log rate of each kind of sample, and ``effect``, its batch's part of it (0 for the reference).

    Reweighted least squares under fixed dispersions; rounds end when no feature's likelihood can gain more than 1e-10.
    """
    matrix, n_kinds = design.matrix(reference), len(design.kinds)
    effects = matrix.copy()
    effects[:, : len(design.groups)] = 0.0
    schema = "feature string, coef array<double>, eta array<double>, effect array<double>, gain double"
    arrow = pa.schema([("feature", pa.string()), *[(c, pa.list_(pa.float64())) for c in ("coef", "eta", "effect")], ("gain", pa.float64())])

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            coef, weight, score = (np.array(batch.column(k).flatten()).reshape(n, -1) for k in (1, 2, 3))
            normal = np.einsum("kp,nk,kq->npq", matrix, weight, matrix)
            ridge = 1e-12 * np.trace(normal, axis1=1, axis2=2)[:, None, None] + 1e-300
            side = score @ matrix
            step = np.linalg.solve(normal + ridge * np.eye(matrix.shape[1]), side[..., None])[..., 0]
            gain = np.abs((step * side).sum(1))
            began = coef.any(axis=1)  # the first solve is no step but a start
            longest = np.where(began, np.abs(step @ matrix.T).max(1), 0.0)
            coef = coef + step * np.minimum(1, 2 / np.maximum(longest, 1e-300))[:, None]
            parts = [pa.array(list(v), pa.list_(pa.float64())) for v in (coef, coef @ matrix.T, coef @ effects.T)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *parts, pa.array(gain)], schema=arrow)

    by_kind = lambda value: F.array(*[F.coalesce(F.sum(F.when(F.col("kind") == k, value)), F.lit(0.0)) for k in range(n_kinds)])
    first = cells.groupBy("feature").agg(by_kind(F.col("n")).alias("n"), by_kind(F.col("depth")).alias("depth"))
    nothing = F.array_repeat(F.lit(0.0), matrix.shape[1])
    weight = F.transform("n", lambda x: x + 0.5)
    score = F.zip_with(weight, "depth", lambda w, d: w * F.log(w / d))  # the rates of the kinds, as a weighted regression from nothing
    state = materialize(first.select("feature", nothing.alias("coef"), weight.alias("weight"), score.alias("score")).mapInArrow(solve, schema))
    rate = F.col("depth") * F.exp(F.get("eta", F.col("kind")))
    own = _of_batch(design, {b: [v] for b, v in phi.items()}, 0)
    for _ in range(ROUNDS):
        met = cells.join(state.select("feature", "coef", "eta"), "feature")
        sums = met.groupBy("feature").agg(F.first("coef").alias("coef"), by_kind(rate / (1 + own * rate)).alias("weight"), by_kind((F.col("n") - rate) / (1 + own * rate)).alias("score"))
        state = materialize(sums.mapInArrow(solve, schema))
        if not state.where("gain > 1e-10").limit(1).count():
            break
    return state.select("feature", "eta", "effect")


def fitted_means(counts: DataFrame, samples: DataFrame, phi: dict[str, float]) -> DataFrame:
    """Fitted means (sample, feature, mu) under given dispersions, of features that have a count in every batch."""
    design = design_of(samples)
    cells = cells_of(counts, samples, design)
    state = fit_effects(cells, design, phi, min(design.batches, key=lambda b: (phi[b], b)))
    return cells.join(state, "feature").select("sample", "feature", (F.col("depth") * F.exp(F.get("eta", F.col("kind")))).alias("mu"))


def correct_batches(counts: DataFrame, samples: DataFrame, phi: dict[str, float] | None = None, keep_zero: bool = False) -> DataFrame:
    """Counts (sample, feature, n) as the batch of least dispersion would have them.

    A cell of another batch goes from its quantile under its own mean and dispersion to that under the mean without the batch effect and
    the reference's dispersion. Where the effect lies below -0.2 the new mean is at most the feature's largest in the reference.
    Without ``phi`` dispersions are estimated. Features that lack a count in some batch come back as they are, with their
    zeros; a sample without metadata raises nothing and is left out, as are cells of unknown samples.
    """
    design = design_of(samples)
    cells = cells_of(counts, samples, design)
    if len(design.batches) < 2:
        return complete(counts, samples)
    phi = dispersions(cells, design) if phi is None else phi
    reference = min(design.batches, key=lambda b: (phi[b], b))
    state = fit_effects(cells, design, phi, reference)
    met = cells.join(state, "feature").withColumns({"mu": F.col("depth") * F.exp(F.get("eta", F.col("kind"))), "gamma": F.get("effect", F.col("kind"))})
    most = met.where(F.col("batch") == reference).groupBy("feature").agg(F.max("mu").alias("most"))
    old = F.greatest(F.col("mu"), F.lit(LEAST_MEAN))
    new = old * F.exp(-F.col("gamma"))
    new = F.when(F.col("gamma") < HELD_BELOW, F.least(new, F.col("most"))).otherwise(new)
    moved = met.where(F.col("batch") != reference).join(most, "feature")
    own = _of_batch(design, {b: [v] for b, v in phi.items()}, 0)
    moved = moved.select("sample", "feature", negbin.matched(F.col("n"), old, own, new, F.lit(phi[reference]), keep_zero).alias("n"))
    same = cells.where(F.col("batch") == reference).select("sample", "feature", F.col("n").cast("long").alias("n"))
    rest = counts.join(cells.select("feature").distinct(), "feature", "left_anti")
    return moved.unionByName(same).unionByName(complete(rest, samples).select("sample", "feature", F.col("n").cast("long").alias("n")))
