"""Registered queries on read pairs, recovered pools and count statistics, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.functions.gene_names import simplify
from tallyseq.operators import anneal, assign, counts, intervals, reads, recover, stats
from tallyseq.plans import catalog
from tallyseq.sources import views

DEPTH = 500
TOP = 20
PANEL = [("P1", "TTGCTTGG"), ("P2", "ACGTACGT"), ("P3", "GGTTAACCA"), ("P4", "AAAACCCCGGGGTTTT")]


def umi_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.extract_umis(views.read_pairs(spark, sf_dir))


def read_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.read_stats(umi_extraction(spark, sf_dir))


def read_mask_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.mask_totals(read_stats(spark, sf_dir))


def reads_per_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.reads_per_gene(views.umi_groups(spark, sf_dir))


def reads_per_umi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.reads_per_umi(views.umi_groups(spark, sf_dir))


def component_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.component_counts(counts.assigned(views.umi_groups(spark, sf_dir)), catalog.gene_components(spark, sf_dir))


def rarefied_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.rarefy(counts.molecule_counts(views.umi_groups(spark, sf_dir)), DEPTH, block=64)


def _dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = views.umi_groups(spark, sf_dir)
    return counts.complete(counts.molecule_counts(groups), groups).withColumnRenamed("n", "value")


def quantile_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.quantile_normalize(_dense(spark, sf_dir)).select("sample", "feature", F.round("value", 6).alias("value"))


def top_deviating_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_deviating(_dense(spark, sf_dir), TOP).select("feature", F.round("sd", 6).alias("sd"))


def fdr_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_partkey % 7 AS family", "(p_partkey * 7919 % 1009 + 1) / 1010D AS p")
    return stats.adjust_fdr(rows, "family").select("id", "family", F.round("q", 9).alias("q"))


def common_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counts.molecule_counts(views.umi_groups(spark, sf_dir))
    batches = found.select("sample").distinct().withColumn("batch", F.when(F.col("sample") < "s3", "a").otherwise("b"))
    return stats.common_features(found.where("n > 1"), batches)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = views.primers(spark, sf_dir).groupBy("pair_id").pivot("primer_type", ["fwd", "rev"]).agg(F.first("primer_seq"))
    return pairs.selectExpr("concat('g', pair_id % 25) AS gene", "pair_id AS amplicon_index", "fwd AS l_seq", "rev AS r_seq")


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes by nation; every third names the forward primer of one pair, and one names a primer that none has."""
    firsts = _candidates(spark, sf_dir).groupBy("gene").agg(F.min("l_seq").alias("least"))
    rows = views.table(spark, sf_dir, "nation").select(F.concat(F.lit("g"), "n_nationkey").alias("gene"), "n_nationkey").where("n_nationkey % 2 = 0").join(firsts, "gene", "left")
    return rows.selectExpr("gene", "CASE WHEN n_nationkey % 3 = 0 THEN least END AS primer_fwd", "CASE WHEN n_nationkey = 8 THEN 'A' END AS primer_rev")


def matched_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover.match_candidates(_wanted(spark, sf_dir), _candidates(spark, sf_dir))


def unmatched_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover.missing_genes(_wanted(spark, sf_dir), _candidates(spark, sf_dir)).select("gene")


def amplicon_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    gene, transcript = (F.concat(F.lit(k), c) for k, c in (("g", F.col("seq_id") % 9), ("t", F.col("seq_id"))))
    return recover.group_facing(views.sequences(spark, sf_dir), catalog._patterns(spark, sf_dir), gene, transcript)


def location_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover.location_checks(catalog.pattern_locations(spark, sf_dir))


def exon_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "lineitem").selectExpr("concat(l_orderkey, '_', l_linenumber) AS read_id", "concat('c', l_suppkey % 5) AS contig", "l_orderkey * 37 % 100000 AS start", "l_orderkey * 37 % 100000 + 99 AS end")
    exons = views.table(spark, sf_dir, "part").selectExpr("concat('G', p_partkey % 40) AS gene", "concat('c', p_partkey % 5) AS contig", "p_partkey * 91 % 100000 AS start", "p_partkey * 91 % 100000 + p_partkey % 300 AS end")
    return intervals.assign_genes(rows, exons)


def _assigned(spark: SparkSession, sf_dir: str, indels: bool) -> DataFrame:
    rows = views.read_pairs(spark, sf_dir).select("read_id", F.col("r1_seq").alias("seq"))
    panel = spark.createDataFrame(PANEL, "adapter string, primer string")
    return assign.assign_primers(rows, panel, 0.125, indels)


def primer_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir, indels=False)


def indel_primer_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that lack bases of the primer or have more, too."""
    return _assigned(spark, sf_dir, indels=True)


def simplified_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of three names from a fixed few of different kinds."""
    kinds = F.array(*map(F.lit, ("Gapdh", "Gm10358", "MT-CO3", "Klk1", "Gapdh-Klk1", "Abcd1Rik", "FOXP3", "KRT8P1", "KRT8", "Selenbp1")))
    at = lambda k: F.get(kinds, F.pmod(F.floor(F.col("p_partkey") / k), F.lit(10)).cast("int"))
    rows = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.array(at(1), at(10), at(100)).alias("names"))
    return rows.select("id", F.array_join(simplify(F.col("names")), "|").alias("names"))


def annealed_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anneal.anneal(_candidates(spark, sf_dir), 60, chains=4).select("gene", "design", F.round("loss", 6).alias("loss"))


_BASES = "translate(md5(({})::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGT')"
_PAIRS = f"""raw AS (SELECT o_orderkey AS k, {_BASES.format("o_orderkey")} AS b1, {_BASES.format("o_orderkey + 7")} AS b2 FROM orders),
made AS (
    SELECT k, concat(substr(b1, 1, CASE WHEN k % 17 = 0 THEN 7 ELSE 6 END), 'TTGGTTGG', substr(b1, 9, 24)) AS s1, concat(substr(b2, 1, 6), 'GGTTGGTT', substr(b2, 9, 24)) AS s2,
        CASE WHEN k % 13 = 0 THEN 'no_adapter' ELSE concat('F', k % 11) END AS a1, concat('R', k % 11) AS a2 FROM raw
), tagged AS (
    SELECT *, CASE WHEN k % 13 = 0 THEN '' ELSE split_part(s1, 'TTGGTTGG', 1) END AS u1, split_part(s2, 'GGTTGGTT', 1) AS u2 FROM made
), cut AS (SELECT *, substr(s1, length(u1) + 1) AS c1, substr(s2, length(u2) + 1) AS c2 FROM tagged)"""
_STATS = f"""{_PAIRS}, stats AS (
    SELECT concat('s', k % 6) AS sample, concat('q', k) AS read_id, a1 AS primer_fwd, a2 AS primer_rev, length(c1) AS r1_length, length(c2) AS r2_length, u1 AS umi5, u2 AS umi3 FROM cut
)"""
_DENSE = f"""{catalog._COUNTS}, grid AS (
    SELECT s.sample, f.feature, coalesce(n, 0) AS value FROM (SELECT DISTINCT sample FROM groups) s CROSS JOIN (SELECT DISTINCT feature FROM counts) f
    LEFT JOIN counts c ON c.sample = s.sample AND c.feature = f.feature
)"""
_WANTED = f"""{catalog._POOL}, candidates AS (
    SELECT concat('g', pair_id % 25) AS gene, pair_id AS amplicon_index, max(seq) FILTER (primer_type = 'fwd') AS l_seq, max(seq) FILTER (primer_type = 'rev') AS r_seq FROM pool GROUP BY pair_id
), wanted AS (
    SELECT concat('g', n_nationkey) AS gene, CASE WHEN n_nationkey % 3 = 0 THEN (SELECT min(l_seq) FROM candidates c WHERE c.gene = concat('g', n_nationkey)) END AS primer_fwd,
        CASE WHEN n_nationkey = 8 THEN 'A' END AS primer_rev FROM nation WHERE n_nationkey % 2 = 0
)"""
_FITS = "w.gene = c.gene AND (w.primer_fwd IS NULL OR w.primer_fwd = c.l_seq) AND (w.primer_rev IS NULL OR w.primer_rev = c.r_seq)"

_SQL = {
    "umi_extraction": f"""WITH {_PAIRS} SELECT concat('s', k % 6) AS sample, concat('q', k, '_', u1, '_', u2) AS read_id, c1 AS r1_seq, repeat('I', length(c1)) AS r1_qual, c2 AS r2_seq, repeat('F', length(c2)) AS r2_qual,
        u1 AS umi1, u2 AS umi2, concat(a1, '+', a2) AS comment FROM cut""",
    "read_stats": f"WITH {_STATS} SELECT * FROM stats",
    "read_mask_totals": f"""WITH {_STATS}, marked AS (SELECT sample, primer_fwd <> 'no_adapter' AS p, length(umi5) = 6 AND length(umi3) = 6 AS u FROM stats)
        SELECT sample, count(*) AS reads, count(*) FILTER (p) AS with_primers, count(*) FILTER (u) AS good_umi, count(*) FILTER (p AND u) AS both FROM marked GROUP BY 1""",
    "reads_per_gene": f"WITH {catalog._GROUPS} SELECT sample, gene, count(*) AS n FROM groups GROUP BY ALL",
    "reads_per_umi": f"WITH {catalog._GROUPS} SELECT sample, concat(gene, ':', final_umi) AS gene_umi, count(*) AS n FROM groups GROUP BY ALL",
    "component_counts": f"""WITH RECURSIVE {catalog._GROUPS}, g AS (SELECT DISTINCT sample, read_id, unnest(string_split(gene, ',')) AS gene FROM groups),
        e AS (SELECT DISTINCT a.gene AS a, b.gene AS b FROM g a JOIN g b ON a.sample = b.sample AND a.read_id = b.read_id AND a.gene <> b.gene WHERE a.gene LIKE 'G%' AND b.gene LIKE 'G%'),
        reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
        parts AS (SELECT a AS gene, array_to_string(list_sort(list(DISTINCT b)), '|') AS component FROM reach GROUP BY a),
        x AS (SELECT sample, final_umi, unnest(string_split(gene, ',')) AS gene FROM assigned)
        SELECT sample, coalesce(component, x.gene) AS component, count(DISTINCT final_umi) AS n FROM x LEFT JOIN parts ON parts.gene = x.gene GROUP BY 1, 2""",
    "rarefied_counts": f"""WITH {catalog._COUNTS}, cells AS (SELECT *, sum(n) OVER (PARTITION BY sample) AS total FROM counts),
        copies AS (SELECT sample, feature, total, unnest(range(1, n + 1)) AS copy FROM cells),
        drawn AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY md5(concat(sample, ':', feature, ':', copy, ':42')), feature, copy) AS rn FROM copies)
        SELECT sample, feature, count(*) AS n FROM drawn WHERE total <= {DEPTH} OR rn <= {DEPTH} GROUP BY 1, 2""",
    "quantile_normalized": f"""WITH {_DENSE}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY value, feature) AS r FROM grid), means AS (SELECT r, avg(value) AS mean FROM ranked GROUP BY r)
        SELECT sample, feature, round(avg(mean) OVER (PARTITION BY sample, value), 6) AS value FROM ranked JOIN means USING (r)""",
    "top_deviating_features": f"WITH {_DENSE} SELECT feature, round(stddev_samp(value), 6) AS sd FROM grid GROUP BY 1 ORDER BY stddev_samp(value) DESC, feature LIMIT {TOP}",
    "fdr_adjusted": """WITH x AS (SELECT p_partkey AS id, p_partkey % 7 AS family, (p_partkey * 7919 % 1009 + 1) / 1010.0::DOUBLE AS p FROM part),
        r AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY p, id) AS rk, count(*) OVER (PARTITION BY family) AS n FROM x)
        SELECT id, family, round(least(1.0::DOUBLE, min(p * n / rk) OVER (PARTITION BY family ORDER BY rk DESC)), 9) AS q FROM r""",
    "common_features": f"WITH {catalog._COUNTS} SELECT feature FROM counts WHERE n > 1 GROUP BY 1 HAVING count(DISTINCT sample < 's3') = (SELECT count(DISTINCT sample < 's3') FROM counts)",
    "matched_candidates": f"WITH {_WANTED} SELECT * FROM candidates c WHERE EXISTS (SELECT 1 FROM wanted w WHERE {_FITS})",
    "unmatched_genes": f"WITH {_WANTED} SELECT gene FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM candidates c WHERE {_FITS})",
    "amplicon_groups": f"""WITH {catalog._LOCATED}, a AS (
            SELECT u.pattern AS fwd, d.pattern AS rev, concat('g', u.seq_id % 9) AS gene_id, concat('t', u.seq_id) AS transcript_id, u.start AS s, d."end" AS e
            FROM located u JOIN located d ON u.seq_id = d.seq_id AND u.strand = '+' AND d.strand = '-' AND u."end" < d.start
        ), o AS (SELECT *, row_number() OVER (PARTITION BY fwd, rev ORDER BY gene_id, transcript_id, s, e) AS rn FROM a)
        SELECT fwd, rev, max(gene_id) FILTER (rn = 1) AS gene_id, max(transcript_id) FILTER (rn = 1) AS transcript_id, max(s) FILTER (rn = 1) AS start, max(e) FILTER (rn = 1) AS "end",
            count(DISTINCT transcript_id) AS num_transcripts, count(DISTINCT gene_id) AS num_genes, count(*) AS num_amplicons, array_to_string(list_sort(list(DISTINCT transcript_id)), ';') AS transcript_id_all
        FROM o GROUP BY fwd, rev""",
    "location_checks": f"""WITH {catalog._LOCATED}, each AS (SELECT pattern, seq_id, count(*) AS n FROM located GROUP BY 1, 2)
        SELECT pattern, sum(n)::BIGINT AS places, count(*) AS transcripts, count(*) FILTER (n > 1) AS repeated_in FROM each GROUP BY 1""",
}

_SQL["exon_assignment"] = """WITH r AS (SELECT concat(l_orderkey, '_', l_linenumber) AS read_id, concat('c', l_suppkey % 5) AS contig, l_orderkey * 37 % 100000 AS s FROM lineitem),
    x AS (SELECT concat('G', p_partkey % 40) AS gene, concat('c', p_partkey % 5) AS contig, p_partkey * 91 % 100000 AS s, p_partkey * 91 % 100000 + p_partkey % 300 AS e FROM part)
    SELECT read_id, coalesce(array_to_string(list_sort(list(DISTINCT gene) FILTER (gene IS NOT NULL)), ','), 'Unassigned') AS gene
    FROM r LEFT JOIN x ON r.contig = x.contig AND r.s <= x.e AND x.s <= r.s + 99 GROUP BY read_id"""
_SQL["primer_assignment"] = f"""WITH {_PAIRS}, p(adapter, primer) AS (VALUES {", ".join(str(x) for x in PANEL)}),
    w AS (SELECT k, s1, adapter, primer, unnest(range(0, length(s1) - length(primer) + 1)) AS start FROM made CROSS JOIN p),
    d AS (SELECT *, substr(s1, start + 1, length(primer)) AS match, levenshtein(substr(s1, start + 1, length(primer)), primer) AS errors FROM w),
    b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY errors, start, adapter) AS rn FROM d WHERE errors <= floor(0.125 * length(primer)))
    SELECT concat('q', made.k) AS read_id, coalesce(adapter, 'no_adapter') AS adapter, coalesce(match, '') AS match, start::INT AS start, errors::INT AS errors FROM made LEFT JOIN b ON b.k = made.k AND rn = 1"""
_SQL["indel_primer_assignment"] = f"""WITH {_PAIRS}, p(adapter, primer) AS (VALUES {", ".join(str(x) for x in PANEL)}),
    s AS (SELECT *, floor(0.125 * length(primer))::INT AS e FROM p),
    z AS (SELECT *, unnest(range(length(primer) - e, length(primer) + e + 1)) AS size FROM s),
    w AS (SELECT k, s1, adapter, primer, e, size, unnest(range(0, length(s1) - size + 1)) AS start FROM made CROSS JOIN z),
    d AS (SELECT *, substr(s1, start + 1, size) AS match, levenshtein(substr(s1, start + 1, size), primer) AS errors FROM w),
    b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY errors, start, abs(size - length(primer)), adapter, size) AS rn FROM d WHERE errors <= e)
    SELECT concat('q', made.k) AS read_id, coalesce(adapter, 'no_adapter') AS adapter, coalesce(match, '') AS match, start::INT AS start, errors::INT AS errors FROM made LEFT JOIN b ON b.k = made.k AND rn = 1"""
_SQL["simplified_names"] = """WITH n AS (
        SELECT p_partkey AS id, [k[p_partkey % 10 + 1], k[p_partkey // 10 % 10 + 1], k[p_partkey // 100 % 10 + 1]] AS l
        FROM part, (SELECT ['Gapdh', 'Gm10358', 'MT-CO3', 'Klk1', 'Gapdh-Klk1', 'Abcd1Rik', 'FOXP3', 'KRT8P1', 'KRT8', 'Selenbp1'] AS k)
    ), d AS (SELECT id, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM n),
    p AS (SELECT *, ['Gm10358', 'Abcd1Rik', 'KRT8P1'] AS pseudo FROM d),
    f AS (SELECT id, l, list_filter(l, lambda x: NOT (x = 'Gapdh-Klk1' AND (list_contains(l, 'Gapdh') OR list_contains(l, 'Klk1')))
        AND NOT (list_contains(pseudo, x) AND len(list_filter(l, lambda y: NOT list_contains(pseudo, y))) > 0)) AS kept FROM p),
    g AS (SELECT id, CASE WHEN len(kept) > 0 THEN kept ELSE l END AS kept FROM f)
    SELECT id, array_to_string(list_filter(kept, lambda x: NOT (x = 'KRT8P1' AND list_contains(kept, 'KRT8'))), '|') AS names FROM g"""

_QUERIES = (umi_extraction, read_stats, read_mask_totals, reads_per_gene, reads_per_umi, component_counts, rarefied_counts, quantile_normalized, top_deviating_features, fdr_adjusted, common_features, matched_candidates, unmatched_genes, amplicon_groups, location_checks, exon_assignment, primer_assignment, indel_primer_assignment, simplified_names, annealed_panel)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
