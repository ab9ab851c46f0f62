"""Quality rules: fixed base limits and a decision list learned by sequential covering.

Rules are grown one at a time on two thirds of a labelled sample: a conjunction of
thresholds takes the condition of the highest information gain until it covers no good
document or grows too long. Pruning on the other third cuts the rule to its best prefix.
What it covers goes, and the next rule is learned from the rest. All counting is done by
Spark aggregates over a binned table; the driver sees histograms of features x bins only.

Defined results for odd input: null and empty texts have no words and fail the base
limits; a text of any length counts whole; without usable labels the list is empty and only the base limits decide; of
conditions with equal gain the first in the order of features and thresholds is taken; rows that
repeat an id are judged by their own texts, and the bound on labelled rows holds for them too; an empty table gives an
empty result; other columns pass through, one that has the name of an added column as name + ``_input``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.llm.names import clear_of
from tallyseq.llm.text_stats import STATISTICS, labelled_features, rates, with_statistics
from tallyseq.session import materialize

#: Labelled rows that a fit reads at most.
SAMPLE = 20_000
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
PREFIX = "__stat_"


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, features: dict[str, Column]) -> Column:
        value = features[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def rule_column(rule: Rule, features: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.column(features) for c in rule])


def verdict(rules: list[Rule], features: dict[str, Column]) -> Column:
    """The number of the first rule that rejects the row (from 1), or 0 if none does."""
    out = F.lit(0)
    for number, rule in reversed([*enumerate(rules, 1)]):
        out = F.when(rule_column(rule, features), F.lit(number)).otherwise(out)
    return out


def _cut_points(rows: DataFrame, names: list[str], points: int) -> dict[str, list[float]]:
    at = [(i + 0.5) / points for i in range(points)]
    exact = lambda n, label: F.percentile_approx(F.when(F.col("label") == label, F.col(n)), at, 10_000)
    got = rows.agg(*[F.array_distinct(F.flatten(F.array(F.coalesce(exact(n, 0), F.array()), F.coalesce(exact(n, 1), F.array())))).alias(n) for n in names]).first()
    return {n: sorted(set(got[n] or [])) for n in names}


def learn_rules(
    rows: DataFrame,
    names: list[str],
    max_rules: int = 8,
    max_conditions: int = 3,
    points: int = 24,
    least_precision: float = 0.9,
    least_covered: int = 5,
) -> list[Rule]:
    """Learn rules that cover label 0. ``rows`` has ``label`` (0 or 1), ``prune`` (boolean) and a double column per name."""
    cuts = {n: c for n, c in _cut_points(rows, names, points).items() if c}
    if not cuts:
        return []
    own = {n: F.col(n) for n in names}
    place = lambda n, c: F.size(F.filter(F.array(*map(F.lit, c)), lambda t: t < F.col(n)))
    bins = [F.struct(F.lit(n).alias("feature"), place(n, c).alias("bin")) for n, c in cuts.items()]
    rows = materialize(rows.withColumn("bins", F.array(*bins)))
    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        rule: Rule = ()
        covered = left.where("not prune")
        while len(rule) < max_conditions:
            hist: dict[str, dict[tuple[int, int], int]] = {n: {} for n in cuts}
            for r in covered.select("label", F.explode("bins").alias("b")).groupBy("b.feature", "b.bin", "label").count().collect():
                hist[r["feature"]][r["bin"], r["label"]] = r["count"]
            some = next(iter(hist.values()))
            bad, good = (sum(v for (_, y), v in some.items() if y == label) for label in (0, 1))
            if bad < least_covered or not good:
                break
            best, chosen = 0.0, None
            for n, points_of in cuts.items():
                below = [0, 0]
                for i, t in enumerate(points_of):
                    for y in (0, 1):
                        below[y] += hist[n].get((i, y), 0)
                    for above, p, q in ((False, *below), (True, bad - below[0], good - below[1])):
                        if p >= least_covered:
                            gain = p * (math.log2(p / (p + q)) - math.log2(bad / (bad + good)))
                            if gain > best + 1e-9:
                                best, chosen = gain, Condition(n, above, t)
            if chosen is None:
                break
            rule = (*rule, chosen)
            covered = covered.where(chosen.column(own))
        if not rule:
            break
        sums = []
        for k in range(1, len(rule) + 1):
            hit = rule_column(rule[:k], own)
            sums += [F.count_if(hit & (F.col("label") == 0)).alias(f"p{k}"), F.count_if(hit & (F.col("label") == 1)).alias(f"q{k}")]
        told = left.where("prune").agg(*sums).first()
        worth = lambda k: ((told[f"p{k}"] - told[f"q{k}"]) / max(1, told[f"p{k}"] + told[f"q{k}"]), told[f"p{k}"])
        k = max(range(1, len(rule) + 1), key=worth)
        p, q = told[f"p{k}"], told[f"q{k}"]
        if p < 1 or p / (p + q) < least_precision:
            break
        rules.append(rule[:k])
        left = left.where(~rule_column(rule[:k], own))
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, **how) -> list[Rule]:
    """Learn the list from at most ``sample`` labelled rows."""
    names = [*rates()]
    rows = labelled_features(docs, labels, sample, id_col, text_col)
    rows = rows.select("label", (F.pmod(F.xxhash64(F.lit(5), "draw"), F.lit(3)) == 0).alias("prune"), *names)
    return learn_rules(materialize(rows), names, **how)


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """Add ``rejected_by`` (-1: a base limit, 0: kept, else the rule's number) and statistics named ``__stat_...``."""
    named = clear_of(docs, "rejected_by", *[PREFIX + c for c in STATISTICS])
    text = named[named.columns[docs.columns.index(text_col)]]
    packed = named.select(F.struct(*[F.col(f"`{c}`") for c in named.columns]).alias("__row"), text.alias("__text"))
    rows = with_statistics(packed, "__text", PREFIX).select("__row.*", *[PREFIX + c for c in STATISTICS])
    words = F.col(PREFIX + "n_words")
    base = (words < MIN_WORDS) | (100 * F.col(PREFIX + "n_repeat_words") > MAX_REPEAT_PERCENT * words)
    return rows.withColumn("rejected_by", F.when(base, F.lit(-1)).otherwise(verdict(rules, rates(PREFIX))))


def keep_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows that no limit and no rule rejects, with the columns of ``docs`` only."""
    names = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col(text_col).alias("__text"))
    return judge(inner, rules, "__text").where("rejected_by = 0").select("__row.*")
