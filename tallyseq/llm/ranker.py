"""Quality classifier: a Bradley-Terry ranking learned from preference pairs.

A good document is preferred to a bad one. A score is linear in threshold indicators of
the text's statistics, and its weights minimise the logistic loss on the differences of
indicators over pairs, by Newton steps with a ridge. The cut is a quantile of the training
scores; scores are squashed so that the cut falls on the decision value.

Defined results for odd input: null and empty texts are scored by their statistics, which
are 0; a text of any length counts whole; without labels of both kinds all scores are 0.5; texts with equal statistics have equal
scores, and a score just at the cut counts as good; rows that repeat an id are scored by their own texts, and the
bound on labelled rows holds for them too; an empty table gives an empty result; other columns pass through, one
that has the name of the score as name + ``_input``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.llm.names import clear_of
from tallyseq.llm.text_stats import labelled_features, rates, with_statistics

#: Labelled rows that a fit reads at most, and preference pairs that it draws from them.
SAMPLE = 20_000
PAIRS = 30_000
DECISION = 0.3


@dataclass(frozen=True)
class Ranking:
    names: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    weights: tuple[tuple[float, ...], ...]
    slope: float
    cut: float

    def score(self, features: dict[str, Column]) -> Column:
        """The squashed score, 0 to 1, as a Spark expression."""
        total = F.lit(0.0)
        for name, cuts, weights in zip(self.names, self.cuts, self.weights, strict=True):
            if cuts:
                steps = np.concatenate([[0.0], np.cumsum(weights)]).tolist()
                place = sum((F.when(features[name] > t, 1).otherwise(0) for t in cuts), F.lit(0))
                total = total + F.get(F.array(*map(F.lit, steps)), place)
        return 1 / (1 + F.exp(-(self.slope * (total - self.cut) + math.log(DECISION / (1 - DECISION)))))


def fit_pairs(x: np.ndarray, good: np.ndarray, names: list[str], points: int = 12, pairs: int = PAIRS, ridge: float = 3.0, seed: int = 3) -> Ranking:
    """Learn from feature rows ``x`` and their labels."""
    i, j = np.nonzero(good)[0], np.nonzero(~good)[0]
    if not len(i) or not len(j):
        none = ((),) * len(names)
        return Ranking(tuple(names), none, none, 1.0, math.log(DECISION / (1 - DECISION)))  # 0.5 for all
    at = (np.arange(points) + 0.5) / points
    cuts = [np.unique(np.concatenate([np.quantile(x[i, k], at), np.quantile(x[j, k], at)])) for k in range(len(names))]
    z = np.concatenate([x[:, k, None] > c[None, :] for k, c in enumerate(cuts)], axis=1).astype(np.float64)
    draw = np.random.default_rng(seed)
    d = z[draw.choice(i, pairs)] - z[draw.choice(j, pairs)]
    w = np.zeros(z.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # the chance that the pair is ordered wrongly
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w)), d.T @ p - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    s = z @ w
    quantiles = np.quantile(s, np.linspace(0.002, 0.998, 499))
    ordered_good, ordered_bad = np.sort(s[i]), np.sort(s[j])
    right = (1 - np.searchsorted(ordered_good, quantiles) / len(i)) + np.searchsorted(ordered_bad, quantiles) / len(j)
    best = np.nonzero(right >= right.max() - 1e-12)[0]
    cut = float(quantiles[best[len(best) // 2]])
    below, above = ordered_bad[ordered_bad < cut], s[s >= cut]
    cut = float((below.max() + above.min()) / 2) if len(below) and len(above) else cut
    ends = np.cumsum([0, *map(len, cuts)])
    parts = tuple(tuple(w[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False))
    return Ranking(tuple(names), tuple(tuple(c.tolist()) for c in cuts), parts, 1.0, cut)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, keep: Column | None = None) -> Ranking:
    """Learn from at most ``sample`` labelled rows; ``keep`` chooses labels by the column ``__label_id``."""
    names = [*rates()]
    got = labelled_features(docs, labels, sample, id_col, text_col, keep=keep).toPandas()
    return fit_pairs(got[names].to_numpy(np.float64).reshape(-1, len(names)), got["label"].to_numpy() == 1, names)


def score(docs: DataFrame, ranking: Ranking, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add the score; a row with ``score >= DECISION`` counts as good."""
    named = clear_of(docs, score_col)
    text = named[named.columns[docs.columns.index(text_col)]]
    inner = named.select(F.struct(*[F.col(f"`{c}`") for c in named.columns]).alias("__row"), text.alias("__text"))
    return with_statistics(inner, "__text", "__stat_").select("__row.*", ranking.score(rates("__stat_")).alias(score_col))


def keep_good(docs: DataFrame, ranking: Ranking, text_col: str = "text") -> DataFrame:
    """The rows at or above the cut, with the columns of ``docs`` only."""
    names = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col(text_col).alias("__text"))
    return with_statistics(inner, "__text", "__stat_").where(ranking.score(rates("__stat_")) >= DECISION).select("__row.*")
