"""Registered queries on the quality of runs, record tags, components of reads and rarefaction plans, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.operators import counts, quality, stats, tags
from tallyseq.sources import views

REPEATS = 3


def _named_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = tags.parse_names(views.alignments(spark, sf_dir))
    return names.select("sample", F.col("fwd").alias("primer_fwd"), F.col("rev").alias("primer_rev"), F.col("umi1").alias("umi5"), F.col("umi2").alias("umi3"))


def qc_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = (views.table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    runs = orders.selectExpr("concat('s', o_orderkey % 7) AS sample", "CASE WHEN o_custkey % 2 = 0 THEN 'r1' ELSE 'r2' END AS read", "o_orderkey AS k")
    raw = runs.groupBy("sample", "read").agg(F.count("*").alias("num_seqs"))
    trimmed = runs.where("k % 19 <> 0 AND k % 7 <> 5").groupBy("sample", "read").agg(F.count("*").alias("num_seqs"))
    star = items.selectExpr("concat('s', l_orderkey % 6) AS sample", "CASE l_partkey % 9 WHEN 0 THEN 'N_unmapped' WHEN 1 THEN 'N_multimapping' ELSE concat('G', l_partkey % 40) END AS gene_id")
    star = star.groupBy("sample", "gene_id").agg(F.count("*").alias("unstranded"))
    groups = views.umi_groups(spark, sf_dir).withColumn("unique_id", F.col("final_umi").cast("long"))
    qualities = items.selectExpr("concat('s', l_orderkey % 6) AS sample", "CASE WHEN l_linenumber % 2 = 0 THEN 'r1' ELSE 'r2' END AS read", "cast(l_quantity AS int) AS quality").groupBy("sample", "read", "quality").agg(F.count("*").alias("count"))
    return quality.run_metrics(raw, trimmed, _named_reads(spark, sf_dir), star, groups, qualities)


def record_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.record_tags(views.alignments(spark, sf_dir)).drop("flag")


def record_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags after the demotion of repeated primaries, and which records carry the gene tag."""
    found = tags.record_tags(views.alignments(spark, sf_dir))
    return found.select("sample", "read_id", "ord", "flag", F.col("xf").isNotNull().alias("folded"))


def mate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.mate_counts(views.alignments(spark, sf_dir))


def repeated_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_reads(views.umi_groups(spark, sf_dir))


def base_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.base_statistics(views.read_pairs(spark, sf_dir), "r1_seq", "r1_qual")


def normalized_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.normalized_counts(counts.assigned(views.umi_groups(spark, sf_dir)))


def torn_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over components of each sample's other reads nothing is torn; here components of even samples meet all reads."""
    reads = counts.consolidate_reads(views.umi_groups(spark, sf_dir))
    parts = views.table(spark, sf_dir, "nation").selectExpr("concat('G', n_nationkey) AS gene", "concat('C', n_regionkey) AS component")
    return counts.torn_reads(reads, parts)


def rarefaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = counts.molecule_counts(views.umi_groups(spark, sf_dir))
    metadata = spark.range(6).selectExpr("concat('s', id) AS sample", "CASE id WHEN 0 THEN 's3' WHEN 1 THEN '250' WHEN 2 THEN 's2' END AS depth_of", "id * 2 AS batch")
    return counts.rarefaction_plan(rows, metadata, REPEATS, key="depth_of")


def restored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of molecules, through log2 counts per million and back."""
    rows = counts.molecule_counts(views.umi_groups(spark, sf_dir))
    return stats.reverse_log2_cpm(counts.log2_cpm(rows), rows).where("n > 0")


def size_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.size_factors(counts.molecule_counts(views.umi_groups(spark, sf_dir)))
    return found.select("sample", F.round("size_factor", 9).alias("size_factor"))


def centered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = counts.molecule_counts(views.umi_groups(spark, sf_dir)).select("sample", "feature", F.col("n").cast("double").alias("value"))
    batches = spark.range(6).selectExpr("concat('s', id) AS sample", "concat('b', id % 2) AS batch")
    return stats.center_batches(values, batches).select("sample", "feature", F.round("value", 9).alias("value"))


_GROUPS = """groups AS (
    SELECT concat('s', l_orderkey % 6) AS sample, concat(l_orderkey, '_', l_linenumber) AS read_id,
        concat(CASE WHEN l_partkey % 7 = 0 THEN 'Unassigned,'
            ELSE concat('G', l_partkey % 40, CASE WHEN l_partkey % 5 = 0 THEN concat(',G', l_suppkey % 40) ELSE '' END, ',') END,
            'F', l_suppkey % 5, '+R', l_suppkey % 3) AS gene,
        l_orderkey % 997 AS tag
    FROM lineitem
)"""
_NAMES = """names AS (
    SELECT concat('s', l_orderkey % 6) AS sample, l_linenumber AS ord, concat('q', l_orderkey) AS read_id,
        translate(lpad((l_orderkey % 1000000)::VARCHAR, 6, '0'), '0123456789', 'ACGTACGTAN') AS umi1,
        translate(lpad((l_orderkey % 99991)::VARCHAR, 6, '0'), '0123456789', 'ACGTACGTAC') AS umi2,
        concat('F', l_orderkey % 11) AS fwd, CASE WHEN l_orderkey % 13 = 0 THEN 'no_adapter' ELSE concat('R', l_orderkey % 11) END AS rev,
        CASE l_linenumber % 4 WHEN 0 THEN 147 WHEN 1 THEN 99 WHEN 2 THEN 355 ELSE 69 END AS flag,
        CASE WHEN l_partkey % 3 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN 'Unassigned' WHEN l_partkey % 5 = 0 THEN concat('G', l_partkey % 9, ',G', l_suppkey % 9) ELSE concat('G', l_partkey % 9) END AS xt
    FROM lineitem
)"""
_MOLECULES = f"{_GROUPS}, molecules AS (SELECT sample, feature, count(*) AS n FROM (SELECT DISTINCT sample, gene, tag, array_to_string(string_split(gene, ',')[:-2], '|') AS feature FROM groups WHERE NOT starts_with(gene, 'Unassigned,')) GROUP BY ALL)"

_SQL = {
    "qc_metrics": f"""
WITH {_GROUPS}, {_NAMES}, runs AS (
    SELECT concat('s', o_orderkey % 7) AS sample, o_custkey % 2 = 0 AS is_first, o_orderkey % 19 <> 0 AND o_orderkey % 7 <> 5 AS passed FROM orders
), raw AS (SELECT sample, count(*) AS num_reads_raw FROM runs WHERE is_first GROUP BY sample),
trimmed AS (SELECT sample, count(*) AS num_reads_qc FROM runs WHERE is_first AND passed GROUP BY sample),
primer AS (
    SELECT sample, count(*) FILTER (WHERE rev <> 'no_adapter') AS num_reads_primer,
        count(*) FILTER (WHERE rev <> 'no_adapter' AND length(umi1) = 6 AND length(umi2) = 6 AND instr(umi1, 'N') = 0 AND instr(umi2, 'N') = 0) AS num_reads_good_umi
    FROM names GROUP BY sample
), mapped AS (SELECT concat('s', l_orderkey % 6) AS sample, count(*) AS num_reads_mapped FROM lineitem WHERE l_partkey % 9 <> 0 GROUP BY 1),
molecules AS (SELECT sample, count(*) AS num_counts, count(DISTINCT (gene, tag)) AS num_umi, count(DISTINCT gene) AS num_genes FROM groups GROUP BY sample),
q AS (
    SELECT concat('s', l_orderkey % 6) AS sample,
        count(*) FILTER (WHERE l_linenumber % 2 = 0 AND l_quantity::INT >= 30)::DOUBLE / count(*) FILTER (WHERE l_linenumber % 2 = 0) AS q30_r1,
        count(*) FILTER (WHERE l_linenumber % 2 = 1 AND l_quantity::INT >= 30)::DOUBLE / count(*) FILTER (WHERE l_linenumber % 2 = 1) AS q30_r2
    FROM lineitem GROUP BY 1
)
SELECT * FROM raw FULL JOIN trimmed USING (sample) FULL JOIN primer USING (sample) FULL JOIN mapped USING (sample) FULL JOIN molecules USING (sample) FULL JOIN q USING (sample)
""",
    "record_tags": f"""
WITH {_NAMES}, marked AS (
    SELECT *, (flag & 64) <> 0 AND (flag & 2304) = 0 AS tagged, concat(fwd, '+', rev) AS primers FROM names
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY sample, read_id, umi1, umi2, primers, tagged ORDER BY ord, xt NULLS FIRST) AS place FROM marked
), genes AS (
    SELECT sample, read_id, umi1, umi2, primers, list(DISTINCT g ORDER BY g) AS found
    FROM (SELECT *, unnest(string_split(coalesce(xt, 'Unassigned'), ',')) AS g FROM marked) WHERE g <> 'Unassigned' AND g <> '' GROUP BY ALL
)
SELECT sample, read_id, ord, CASE WHEN tagged THEN sample END AS cb, CASE WHEN tagged THEN umi1 END AS us, CASE WHEN tagged THEN primers END AS pr,
    CASE WHEN tagged AND length(umi1) = 6 AND length(umi2) = 6 AND instr(umi1 || umi2, 'N') = 0 AND fwd <> 'no_adapter' AND rev <> 'no_adapter' THEN umi1 || umi2 END AS uc,
    CASE WHEN tagged AND xt IS NULL THEN -1 END AS xn, CASE WHEN tagged AND xt IS NULL THEN 'Unassigned' ELSE xt END AS xt,
    CASE WHEN tagged AND place = 1 THEN concat(coalesce(array_to_string(found, ','), 'Unassigned'), ',', primers) END AS xf
FROM placed LEFT JOIN genes USING (sample, read_id, umi1, umi2, primers)
""",
    "record_flags": f"""
WITH {_NAMES}, mates AS (SELECT *, CASE WHEN (flag & 64) <> 0 THEN 1 WHEN (flag & 128) <> 0 THEN 2 ELSE 0 END AS mate, (flag & 2304) = 0 AS main FROM names),
placed AS (SELECT *, main AND mate > 0 AND row_number() OVER (PARTITION BY sample, read_id, umi1, umi2, fwd, rev, mate, main ORDER BY ord, xt NULLS FIRST) > 1 AS again FROM mates)
SELECT sample, read_id, ord, (CASE WHEN again THEN flag | 256 ELSE flag END)::INTEGER AS flag, main AND mate = 1 AND NOT again AS folded FROM placed
""",
    "mate_counts": f"""
WITH {_NAMES}, n AS (
    SELECT sample, count(*) FILTER (WHERE flag & 64 > 0) AS n_first, count(*) FILTER (WHERE flag & 128 > 0) AS n_second FROM names WHERE flag & 256 = 0 AND flag & 2048 = 0 GROUP BY sample
) SELECT s.sample, coalesce(n_first, 0) AS n_first, coalesce(n_second, 0) AS n_second, coalesce(n_first, 0) = coalesce(n_second, 0) AS paired FROM (SELECT DISTINCT sample FROM names) s LEFT JOIN n USING (sample)
""",
    "repeated_reads": "SELECT concat('s', l_orderkey % 6) AS sample, concat(l_orderkey, '_', l_linenumber) AS read_id, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "base_statistics": """
WITH reads AS (
    SELECT concat('s', o_orderkey % 6) AS sample,
        concat(substr(b, 1, CASE WHEN o_orderkey % 17 = 0 THEN 7 ELSE 6 END), 'TTGGTTGG', substr(b, 9, 24)) AS seq, CASE WHEN o_orderkey % 17 = 0 THEN 39 ELSE 38 END AS n
    FROM (SELECT o_orderkey, translate(md5(o_orderkey::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGT') AS b FROM orders)
)
SELECT sample, count(*) AS num_seqs, sum(n)::BIGINT AS sum_len, min(n)::BIGINT AS min_len, round(avg(n), 1) AS avg_len, max(n)::BIGINT AS max_len, 100.0::DOUBLE AS q20, 100.0::DOUBLE AS q30,
    round(100.0::DOUBLE * sum(length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) / sum(n), 2) AS gc
FROM reads GROUP BY sample
""",
    "normalized_counts": f"""
WITH RECURSIVE {_GROUPS}, reads AS (
    SELECT sample, read_id, min(tag) AS tag, list(DISTINCT g ORDER BY g) AS genes
    FROM (SELECT *, unnest(string_split(gene, ',')[:-2]) AS g FROM groups WHERE NOT starts_with(gene, 'Unassigned,')) GROUP BY sample, read_id
), links AS (SELECT DISTINCT a, b FROM (SELECT unnest(genes) AS a, genes FROM reads), unnest(genes) AS t(b) WHERE a <> b),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
named AS (SELECT a AS g, array_to_string(list(b ORDER BY b), '|') AS component FROM (SELECT a, b FROM reach UNION SELECT a, a FROM links) GROUP BY a)
SELECT sample, coalesce(component, genes[1]) AS component, count(DISTINCT tag) AS n FROM reads LEFT JOIN named ON g = genes[1] GROUP BY ALL
""",
    "torn_reads": f"""
WITH {_GROUPS}, tokens AS (SELECT sample, read_id, unnest(string_split(gene, ',')) AS g FROM groups)
SELECT sample, read_id, count(DISTINCT coalesce('C' || n_regionkey, g)) AS n FROM tokens LEFT JOIN nation ON g = 'G' || n_nationkey GROUP BY sample, read_id HAVING count(DISTINCT coalesce('C' || n_regionkey, g)) > 1
""",
    "rarefaction_plan": f"""
WITH {_MOLECULES}, totals AS (SELECT sample, sum(n)::BIGINT AS total FROM molecules GROUP BY sample), metadata AS (
    SELECT concat('s', i) AS sample, CASE i WHEN 0 THEN 's3' WHEN 1 THEN '250' WHEN 2 THEN 's2' END AS depth_of, i * 2 AS batch FROM range(6) t(i)
), wanted AS (
    SELECT m.*, t.total, CASE WHEN depth_of IS NULL THEN (SELECT min(total) - 1 FROM totals) WHEN depth_of = '250' THEN 250 ELSE o.total END AS target
    FROM metadata m JOIN totals t USING (sample) LEFT JOIN totals o ON o.sample = m.depth_of
)
SELECT concat(sample, '_rarefied_', j) AS sample, depth_of, batch, total, target, sample AS original_sample FROM wanted, range({REPEATS}) r(j) WHERE j = 0 OR total > target
""",
    "size_factors": f"""
WITH {_MOLECULES}, means AS (SELECT feature, avg(ln(n)) AS m FROM molecules GROUP BY feature HAVING count(*) = (SELECT count(DISTINCT sample) FROM molecules))
SELECT sample, round(exp(median(ln(n) - m)), 9) AS size_factor FROM molecules JOIN means USING (feature) GROUP BY sample
""",
    "centered_batches": f"""
WITH {_MOLECULES}, b AS (SELECT *, substr(sample, 2)::INT % 2 AS batch FROM molecules)
SELECT sample, feature, round(n - avg(n) OVER (PARTITION BY feature, batch) + avg(n) OVER (PARTITION BY feature), 9) AS value FROM b
""",
    "restored_counts": f"WITH {_MOLECULES} SELECT sample, feature, n FROM molecules",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (qc_metrics, record_tags, record_flags, mate_counts, repeated_reads, base_statistics, normalized_counts, torn_reads, rarefaction_plan, restored_counts, size_factors, centered_batches)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
