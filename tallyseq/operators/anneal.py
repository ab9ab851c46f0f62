"""Choice of one primer pair per gene with little dimer loss, by simulated annealing.

A chain is sequential by nature. Chains of different seeds are independent, so Spark runs them side by
side and the best one wins. A chain gets the designs as Arrow columns and makes the tails of those alone that its steps look at.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A chain holds the sequences of the whole panel, twice while it sorts them, some hundred bytes a design; larger ones raise.
MOST_DESIGNS = 10_000_000
HEAT = 1e6


def unit_of(most_from_end: int) -> int:
    """The least number that each distance from the end divides."""
    return math.lcm(*range(1, most_from_end + 2))


_PAIRED = str.maketrans("ACGTacgt", "TGCAtgca")


def design_tails(l_seq: str | None, r_seq: str | None, k_min: int, k_max: int, most_from_end: int) -> tuple[list[tuple[str, str, float, float]], float]:
    """A design's tails (tail, reverse complement, score times closeness to the end, closeness), both primers', and its self loss.

    Closeness is in units of ``unit_of(most_from_end)``, so that all are whole numbers and sums of them exact.
    """
    unit, every, own = unit_of(most_from_end), [], 0.0
    for s in (l_seq or "", r_seq or ""):
        cuts = [(s[len(s) - d - k : len(s) - d], float(unit // (d + 1))) for k in range(k_min, k_max + 1) for d in range(most_from_end + 1) if k + d <= len(s)]
        one = [(t, t[::-1].translate(_PAIRED), 2.0 ** (len(t) + t.count("G") + t.count("C")) * near, near) for t, near in cuts]
        met: Counter = Counter()
        for _, rc, _, near in one:
            met[rc] += near
        own += sum(score * met[t] for t, _, score, _ in one if t in met)
        every += one
    return every, own


def run_chain(genes: list[range], tails_of: Callable[[int], tuple[list, float]], steps: int, seed: int, unit: int = 1) -> tuple[list[float], list[int]]:
    """Losses by step, and the places of the designs of the best step. ``genes`` are the places of each gene's designs.

    ``tails_of`` gives the tails of a design; it is asked for those that a step looks at alone.
    """
    draw = random.Random(seed)
    chosen = [g[0] for g in genes]
    weights: Counter = Counter()
    scores: Counter = Counter()

    own: Counter = Counter()

    def put(design: int, sign: int) -> None:
        every, alone = tails_of(design)
        own["loss"] += sign * alone
        for tail, rc, score, near in every:
            weights[rc] += sign * near
            scores[tail] += sign * score

    for design in chosen:
        put(design, 1)
    loss_of = lambda: (own["loss"] + sum(s * weights[t] for t, s in scores.items() if t in weights)) / unit**2
    movable = [i for i, g in enumerate(genes) if len(g) > 1]
    loss = loss_of()
    losses, best, best_loss = [loss], [*chosen], loss
    for step in range(steps + steps // 2 if movable else 0):
        at = draw.choice(movable)
        old, new = chosen[at], genes[at][draw.randrange(len(genes[at]) - 1)]
        if new >= old:  # one of the others
            new += 1
        put(old, -1)
        put(new, 1)
        changed = loss_of()
        if changed < loss or (step < steps and draw.random() < math.exp(max(-700.0, (loss - changed) / (HEAT / (step + 1))))):
            chosen[at], loss = new, changed
            if loss < best_loss:
                best, best_loss = [*chosen], loss
        else:
            put(new, -1)
            put(old, 1)
        losses.append(loss)
    return losses, best


def anneal(candidates: DataFrame, steps: int, chains: int = 8, k_min: int = 4, k_max: int = 12, most_from_end: int = 2, seed: int = 42) -> DataFrame:
    """(gene, design) of the best chain. ``candidates``: gene, amplicon_index, l_seq, r_seq; rows without a gene are left out."""
    rows = candidates.where("gene is not null").select("gene", F.col("amplicon_index").alias("design"), "l_seq", "r_seq")
    if rows.count() > MOST_DESIGNS:
        raise ValueError(f"a panel has at most {MOST_DESIGNS} designs")

    def one(key: tuple, designs: pa.Table) -> pa.Table:
        designs = designs.sort_by([("gene", "ascending"), ("design", "ascending")])
        number = designs["gene"].combine_chunks().dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
        seqs = [designs[c].combine_chunks() for c in ("l_seq", "r_seq")]
        tails_of = lambda at: design_tails(seqs[0][at].as_py(), seqs[1][at].as_py(), k_min, k_max, most_from_end)
        chain = key[0].as_py()
        losses, best = run_chain([range(a, b) for a, b in zip(cuts, cuts[1:], strict=False)], tails_of, steps, seed + chain, unit_of(most_from_end))
        told = {"chain": pa.array([chain] * len(best), pa.int64()), "loss": pa.array([min(losses)] * len(best), pa.float64())}
        return designs.select(["gene", "design"]).take(best).append_column("chain", told["chain"]).append_column("loss", told["loss"])

    kinds = dict(rows.dtypes)
    each = rows.withColumn("chain", F.explode(F.sequence(F.lit(0), F.lit(chains - 1))))
    found = each.groupBy("chain").applyInArrow(one, f"gene {kinds['gene']}, design {kinds['design']}, chain long, loss double")
    best = found.groupBy("gene").agg(F.min_by(F.struct("design", "chain", "loss"), F.struct("loss", "chain")).alias("b"))
    return best.select("gene", "b.*")
