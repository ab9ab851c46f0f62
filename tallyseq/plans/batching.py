"""Registered queries on batches of samples, each with its SQL: fitted means, correction, pairing, regression, draws."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.operators import batches, counts, draws, pairing, stabilize
from tallyseq.plans import runs
from tallyseq.sources import views

#: Dispersions of the two batches.
PHI = {"b0": 0.05, "b1": 0.2}
NEIGHBOURS, TOP = 2, 40
TREND = stabilize.Trend(0.08, 2.5)


def _samples(spark: SparkSession, sf_dir: str, group: str) -> DataFrame:
    every = views.batch_counts(spark, sf_dir).select("sample").distinct()
    number = F.substring("sample", 2, 9).cast("int")
    return every.select("sample", F.concat(F.lit("b"), number % 2).alias("batch"), F.when(number % 6 < 3, "g0").otherwise(group).alias("group"))


def batch_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted means of a design of two batches, under given dispersions."""
    found = batches.fitted_means(views.batch_counts(spark, sf_dir), _samples(spark, sf_dir, "g0"), PHI)
    return found.select("sample", "feature", F.round("mu", 6).alias("mu"))


def batch_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the second batch at their quantiles in the first one's distribution."""
    return batches.correct_batches(views.batch_counts(spark, sf_dir), _samples(spark, sf_dir, "g0"), PHI)


def batch_corrected_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with groups kept apart and dispersions estimated: beyond SQL."""
    return batches.correct_batches(views.batch_counts(spark, sf_dir), _samples(spark, sf_dir, "g1"))


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.batch_counts(spark, sf_dir)
    return counts.log2_cpm(counts.complete(rows, rows.select("sample")))


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _samples(spark, sf_dir, "g1").select("sample", "group")


def nearest_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.nearest(_values(spark, sf_dir), _groups(spark, sf_dir), NEIGHBOURS, TOP)


def pair_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = _values(spark, sf_dir)
    found = pairing.pair_corrected(values, pairing.nearest(values, _groups(spark, sf_dir), 1, TOP))
    return found.select("sample", "feature", F.round("value", 8).alias("value"))


def group_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve samples in two groups: the tail has ten degrees of freedom and so a closed form."""
    found = pairing.regress_groups(_values(spark, sf_dir), _groups(spark, sf_dir))
    return found.select("feature", *[F.round(c, 8).alias(c) for c in ("t", "p", "q")])


def drawn_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws to each sample's own depth: molecules drawn, and cells that hold more than their original."""
    rows = counts.molecule_counts(views.umi_groups(spark, sf_dir))
    plan = runs.rarefaction_plan(spark, sf_dir)
    drawn = draws.draw_samples(rows, plan)
    met = plan.select("sample", "original_sample", "target").join(drawn, "sample")
    met = met.join(rows.withColumnsRenamed({"sample": "original_sample", "n": "own"}), ["original_sample", "feature"], "left")
    return met.groupBy("sample", "original_sample", "target").agg(F.sum("n").alias("drawn"), F.count_if(F.col("own").isNull() | (F.col("n") > F.col("own"))).alias("too_many"))


def stabilized_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transform under a given trend, zeros too."""
    found = stabilize.stabilized(views.batch_counts(spark, sf_dir), TREND)
    return found.select("sample", "feature", F.round("value", 8).alias("value"))


def feature_dispersions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stabilize.dispersions(views.batch_counts(spark, sf_dir), _samples(spark, sf_dir, "g0").select("sample", "batch"))
    return found.select("feature", F.round("mean", 8).alias("mean"), F.round("dispersion", 8).alias("dispersion"))


_COUNTS = """counts AS (
    SELECT concat('s', l_suppkey % 12) AS sample, concat('G', l_partkey % 60) AS feature, count(*) * (1 + l_partkey % 60 % 5 * (1 + l_suppkey % 12 % 2)) AS n
    FROM lineitem WHERE l_partkey % 60 <> 59 OR l_suppkey % 2 = 0 GROUP BY l_suppkey % 12, l_partkey % 60
)"""
_STEPS = 14


def _fit_sql() -> str:
    steps = "".join(
        f"""fit{k + 1} AS (
    SELECT f.feature, f.batch, any_value(eta) + sum((n - depth * exp(eta)) / (1 + phi * depth * exp(eta))) / sum(depth * exp(eta) / (1 + phi * depth * exp(eta))) AS eta
    FROM cells c JOIN fit{k} f ON f.feature = c.feature AND f.batch = c.batch GROUP BY f.feature, f.batch
), """
        for k in range(_STEPS)
    )
    return f"""WITH {_COUNTS}, seen AS (SELECT feature FROM counts GROUP BY feature HAVING count(DISTINCT substr(sample, 2)::INT % 2) = 2),
depths AS (SELECT sample, sum(n)::DOUBLE AS depth FROM counts JOIN seen USING (feature) GROUP BY sample),
cells AS (
    SELECT sample, feature, coalesce(n, 0)::DOUBLE AS n, depth, substr(sample, 2)::INT % 2 AS batch, CASE WHEN substr(sample, 2)::INT % 2 = 0 THEN {PHI["b0"]}::DOUBLE ELSE {PHI["b1"]}::DOUBLE END AS phi
    FROM (SELECT DISTINCT sample FROM counts) CROSS JOIN seen LEFT JOIN counts USING (sample, feature) JOIN depths USING (sample)
), fit0 AS (SELECT feature, batch, ln(sum(n) / sum(depth)) AS eta FROM cells GROUP BY feature, batch), {steps}
fitted AS (SELECT sample, feature, n, batch, phi, depth * exp(eta) AS mu, eta FROM cells JOIN fit{_STEPS} USING (feature, batch))"""


_VALUES = f"""{_COUNTS}, grid AS (SELECT sample, feature, coalesce(n, 0) AS n FROM (SELECT DISTINCT sample FROM counts) CROSS JOIN (SELECT DISTINCT feature FROM counts) LEFT JOIN counts USING (sample, feature)),
depth AS (SELECT sample, sum(n) AS depth FROM grid GROUP BY sample),
vals AS (SELECT sample, feature, log2(1 + n / depth * least((SELECT avg(depth) FROM depth), 1e6::DOUBLE)) AS value, CASE WHEN substr(sample, 2)::INT % 6 < 3 THEN 'g0' ELSE 'g1' END AS grp FROM grid JOIN depth USING (sample))"""
_FACTORS = """ratios AS (SELECT feature, avg(ln(n)) AS m FROM counts GROUP BY feature HAVING count(*) = (SELECT count(DISTINCT sample) FROM counts)),
factors AS (SELECT sample, exp(median(ln(n) - m)) AS size_factor FROM counts JOIN ratios USING (feature) GROUP BY sample)"""
_PAIRS = f"""{_VALUES}, tops AS (SELECT feature FROM vals GROUP BY feature ORDER BY stddev_samp(value) DESC, feature LIMIT {TOP}),
centred AS (SELECT sample, grp, feature, value - avg(value) OVER (PARTITION BY feature, grp) AS x FROM vals JOIN tops USING (feature)),
cors AS (
    SELECT a.sample, a.grp AS home, b.grp, b.sample AS match, round(corr(a.x, b.x), 12) AS cor FROM centred a JOIN centred b USING (feature) GROUP BY a.sample, a.grp, b.grp, b.sample
), pairs AS (SELECT sample, grp, match, row_number() OVER (PARTITION BY sample, grp ORDER BY sample <> match, cor DESC, match) AS place FROM cors)"""

_SQL = {
    "batch_means": f"{_fit_sql()} SELECT sample, feature, round(mu, 6) AS mu FROM fitted",
    "batch_corrected": f"""{_fit_sql()}, facing AS (
    SELECT f.*, f.eta - r.eta AS gamma, most FROM fitted f JOIN (SELECT feature, eta FROM fit{_STEPS} WHERE batch = 0) r USING (feature) JOIN (SELECT feature, max(mu) AS most FROM fitted WHERE batch = 0 GROUP BY feature) USING (feature) WHERE f.batch = 1
), moved AS (SELECT *, greatest(mu, 1e-4) AS old_mu, CASE WHEN gamma < -0.2 THEN least(greatest(mu, 1e-4) * exp(-gamma), most) ELSE greatest(mu, 1e-4) * exp(-gamma) END AS new_mu FROM facing),
old_p AS (
    SELECT sample, feature, n, new_mu, sum(exp(lgamma(k + 1 / phi) - lgamma(1 / phi) - lgamma(k + 1) + k * ln(phi * old_mu / (1 + phi * old_mu)) - ln(1 + phi * old_mu) / phi)) AS p
    FROM moved, unnest(range(n::BIGINT + 1)) AS t(k) GROUP BY ALL
), masses AS (
    SELECT sample, feature, n, p, k, sum(exp(lgamma(k + {1 / PHI["b0"]}) - lgamma({1 / PHI["b0"]}::DOUBLE) - lgamma(k + 1) + k * ln({PHI["b0"]} * new_mu / (1 + {PHI["b0"]} * new_mu)) - ln(1 + {PHI["b0"]} * new_mu) / {PHI["b0"]}))
        OVER (PARTITION BY sample, feature ORDER BY k) AS reached
    FROM old_p, unnest(range((20 * new_mu)::BIGINT + 200)) AS t(k)
), told AS (SELECT sample, feature, CASE WHEN abs(any_value(p) - 1) < 1e-6 THEN any_value(n) ELSE min(k) FILTER (WHERE reached >= p) END::BIGINT AS n FROM masses GROUP BY sample, feature)
SELECT * FROM told UNION ALL SELECT sample, feature, n::BIGINT FROM fitted WHERE batch = 0
UNION ALL SELECT s.sample, f.feature, coalesce(n, 0)::BIGINT FROM (SELECT DISTINCT sample FROM counts) s CROSS JOIN (SELECT DISTINCT feature FROM counts WHERE feature NOT IN (FROM seen)) f LEFT JOIN counts USING (sample, feature)
""",
    "nearest_pairs": f'WITH {_PAIRS} SELECT sample, grp AS "group", place::INTEGER AS place, match FROM pairs WHERE place <= {NEIGHBOURS}',
    "pair_corrected": f"""
WITH {_PAIRS}, one AS (SELECT sample AS pair, match FROM pairs WHERE place = 1),
effects AS (SELECT feature, pair, avg(value) AS effect FROM one JOIN vals ON vals.sample = match GROUP BY feature, pair),
own AS (SELECT feature, match AS sample, avg(effect) AS effect FROM one JOIN effects USING (pair) GROUP BY feature, match)
SELECT sample, feature, round(value - effect + avg(value) OVER (PARTITION BY feature) - avg(value - effect) OVER (PARTITION BY feature), 8) AS value FROM vals JOIN own USING (sample, feature)
""",
    "group_regression": f"""
WITH {_VALUES}, sums AS (SELECT feature, grp, count(*) AS n, avg(value) AS m, var_pop(value) * count(*) AS ss FROM vals GROUP BY feature, grp),
fit AS (SELECT a.feature, (b.m - a.m) / sqrt((a.ss + b.ss) / (a.n + b.n - 2) * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n)) AS t FROM sums a JOIN sums b ON a.feature = b.feature AND a.grp = 'g0' AND b.grp = 'g1'),
tails AS (SELECT feature, t, abs(t) / sqrt(10 + t * t) AS s, 10 / (10 + t * t) AS c FROM fit),
ps AS (SELECT feature, t, 1 - s * (1 + c / 2 + 3 * c * c / 8 + 5 * c ** 3 / 16 + 35 * c ** 4 / 128) AS p FROM tails),
ranked AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p, feature) AS v, row_number() OVER (ORDER BY p, feature) AS r FROM ps)
SELECT feature, round(t, 8) AS t, round(p, 8) AS p, round(least(1, min(v) OVER (ORDER BY r DESC)), 8) AS q FROM ranked
""",
    "stabilized_counts": f"""
WITH {_COUNTS}, {_FACTORS}, grid AS (SELECT sample, feature, coalesce(n, 0) / size_factor AS q FROM factors CROSS JOIN (SELECT DISTINCT feature FROM counts) LEFT JOIN counts USING (sample, feature))
SELECT sample, feature, round(log2((1 + {TREND.slope} + 2 * {TREND.floor} * q + 2 * sqrt({TREND.floor} * q * (1 + {TREND.slope} + {TREND.floor} * q))) / (4 * {TREND.floor})), 8) AS value FROM grid
""",
    "feature_dispersions": f"""
WITH {_COUNTS}, {_FACTORS}, grid AS (SELECT sample, feature, substr(sample, 2)::INT % 2 AS batch, coalesce(n, 0) / size_factor AS q FROM factors CROSS JOIN (SELECT DISTINCT feature FROM counts) LEFT JOIN counts USING (sample, feature)),
moved AS (SELECT *, q - avg(q) OVER (PARTITION BY feature, batch) AS d FROM grid)
SELECT feature, round(avg(q), 8) AS mean, round((sum(d * d) / (count(*) - 2) - (SELECT avg(1 / size_factor) FROM factors) * avg(q)) / (avg(q) * avg(q)), 8) AS dispersion FROM moved GROUP BY feature
""",
    "drawn_samples": f"{runs._SQL['rarefaction_plan'].replace('SELECT concat(sample', ', named AS (SELECT concat(sample')}) SELECT sample, original_sample, target, least(target, total)::BIGINT AS drawn, 0::BIGINT AS too_many FROM named",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (batch_means, batch_corrected, batch_corrected_groups, nearest_pairs, pair_corrected, group_regression, stabilized_counts, feature_dispersions, drawn_samples)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
