"""Registered queries over the test tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.functions.sequence import gc_count, reverse_complement
from tallyseq.operators import counts, primers, tags
from tallyseq.plans import summary
from tallyseq.sources import views

FLAGSHIP = "umi_dedup_counts"
K = 9

_GROUPS = """groups AS (
    SELECT concat('s', l_orderkey % 6) AS sample, concat(l_orderkey, '_', l_linenumber) AS read_id,
        concat(CASE WHEN l_partkey % 7 = 0 THEN 'Unassigned,'
            ELSE concat('G', l_partkey % 40, CASE WHEN l_partkey % 5 = 0 THEN concat(',G', l_suppkey % 40) ELSE '' END, ',') END,
            'F', l_suppkey % 5, '+R', l_suppkey % 3) AS gene,
        lpad((l_orderkey % 997)::VARCHAR, 4, '0') AS final_umi
    FROM lineitem
), assigned AS (
    SELECT *, array_to_string(string_split(gene, ',')[:-2], '|') AS feature FROM groups WHERE NOT starts_with(gene, 'Unassigned,')
)"""
_COUNTS = f"{_GROUPS}, counts AS (SELECT sample, feature, count(*) AS n FROM (SELECT DISTINCT sample, gene, final_umi, feature FROM assigned) GROUP BY ALL)"
_ALIGN = """records AS (
    SELECT concat('s', l_orderkey % 6) AS sample, l_linenumber AS ord,
        concat('q', l_orderkey) AS read_id,
        translate(lpad((l_orderkey % 1000000)::VARCHAR, 6, '0'), '0123456789', 'ACGTACGTAN') AS umi1,
        translate(lpad((l_orderkey % 99991)::VARCHAR, 6, '0'), '0123456789', 'ACGTACGTAC') AS umi2,
        concat('F', l_orderkey % 11) AS fwd,
        CASE WHEN l_orderkey % 13 = 0 THEN 'no_adapter' ELSE concat('R', l_orderkey % 11) END AS rev,
        CASE l_linenumber % 4 WHEN 0 THEN 147 WHEN 1 THEN 99 WHEN 2 THEN 355 ELSE 69 END AS flag,
        CASE WHEN l_partkey % 3 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN 'Unassigned' WHEN l_partkey % 5 = 0 THEN concat('G', l_partkey % 9, ',G', l_suppkey % 9) ELSE concat('G', l_partkey % 9) END AS xt
    FROM lineitem
), firsts AS (
    SELECT *, row_number() OVER (PARTITION BY sample, read_id, umi1, umi2, fwd, rev, (flag & 192), (flag & 2304) = 0 ORDER BY ord) = 1 AS is_first FROM records
), names AS (
    SELECT sample, concat(read_id, '_', umi1, '_', umi2, '_', fwd, '+', rev) AS qname, umi1, umi2, fwd, rev,
        bool_or((flag & 64) <> 0 AND (flag & 2304) = 0 AND is_first) AS r1,
        bool_or((flag & 64) <> 0 AND (flag & 2304) = 0 AND is_first AND (flag & 4) = 0) AS mapped,
        list_sort(list_distinct(list_filter(flatten(list(string_split(coalesce(xt, ''), ','))), lambda g: g <> '' AND g <> 'Unassigned'))) AS genes,
        length(umi1) = 6 AND length(umi2) = 6 AND NOT contains(umi1, 'N') AND NOT contains(umi2, 'N') AND fwd <> 'no_adapter' AND rev <> 'no_adapter' AS ok
    FROM firsts GROUP BY ALL
)"""
_SEQ = """seqs AS (
    SELECT p_partkey AS id, translate(concat(md5(p_partkey::VARCHAR), md5(concat('x', p_partkey))), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM part
)"""
_POOL = """pairs AS (
    SELECT s_suppkey AS pair_id, translate(md5(s_suppkey::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGT') AS cut FROM supplier
), pool AS (
    SELECT pair_id, 'fwd' AS primer_type, substr(cut, 3, 14) AS seq, concat(pair_id, 'fwd') AS id FROM pairs
    UNION ALL SELECT pair_id, 'rev', reverse(translate(substr(cut, 19, 14), 'ACGT', 'TGCA')), concat(pair_id, 'rev') FROM pairs
)"""
_RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"
_SCORE = "pow(2, length({0}) + length({0}) - length(translate({0}, 'GC', '')))"


def _pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.primers(spark, sf_dir).select(F.concat("pair_id", "primer_type").alias("id"), F.col("primer_seq").alias("seq"))


def umi_dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.molecule_counts(views.umi_groups(spark, sf_dir))


def raw_read_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.raw_counts(views.umi_groups(spark, sf_dir))


def umi_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = counts.assigned(views.umi_groups(spark, sf_dir)).withColumnRenamed("final_umi", "umi")
    return counts.group_umis(reads).select("sample", "read_id", "gene", "umi", "umi_count")


def count_matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = views.umi_groups(spark, sf_dir)
    return counts.complete(counts.molecule_counts(groups), groups)


def mean_relative_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counts.mean_abundance(counts.molecule_counts(views.umi_groups(spark, sf_dir)))
    return found.select("feature", F.round("abundance", 9).alias("abundance"))


def consolidated_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.consolidate_reads(views.umi_groups(spark, sf_dir)).select("sample", "read_id", F.array_join("genes", "|").alias("genes"))


def _genes_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = counts.consolidate_reads(views.umi_groups(spark, sf_dir))
    return reads.withColumn("genes", F.filter("genes", lambda g: g.startswith("G")))


def gene_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.cooccurrence(_genes_only(spark, sf_dir))


def gene_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.gene_components(counts.cooccurrence(_genes_only(spark, sf_dir)))


def symbol_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counts.molecule_counts(views.umi_groups(spark, sf_dir))
    symbols = found.select("feature").distinct().select("feature", F.concat(F.lit("S"), F.substring_index("feature", "|", 1)).alias("symbol"))
    return counts.collapse_symbols(found, symbols)


def log2_cpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counts.log2_cpm(counts.molecule_counts(views.umi_groups(spark, sf_dir)))
    return found.select("sample", "feature", F.round("value", 6).alias("value"))


def tag_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tags.fold_names(tags.demote_repeats(views.alignments(spark, sf_dir)))
    return found.select("sample", "qname", "xf", "mapped", "assigned", "criteria_ok", "counted")


def tag_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.run_totals(tags.fold_names(tags.demote_repeats(views.alignments(spark, sf_dir))))


def primer_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    return views.sequences(spark, sf_dir).select("seq_id", reverse_complement(seq).alias("rc"), gc_count(seq).alias("gc"))


def kmer_complement_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return primers.complement_hits(_pool(spark, sf_dir), K, K)


def pool_complement_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 4 to 8 bases."""
    return primers.complement_hits(_pool(spark, sf_dir))


def primer_dimer_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = primers.dimer_loss(_pool(spark, sf_dir), 4, 8, 3, with_self=False)
    return found.select("id", F.round("loss", 4).alias("loss"))


def pool_saddle_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tails of 4 to 12 bases up to 2 from the end, with self loss."""
    return primers.dimer_loss(_pool(spark, sf_dir)).select("id", F.round("loss", 4).alias("loss"))


def _patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of eight bases from the primers' 3' ends, so that the short test transcripts hold some."""
    return views.primers(spark, sf_dir).select("primer_type", F.substring("primer_seq", 7, 8).alias("pattern")).groupBy("pattern").agg(F.min("primer_type").alias("primer_type"))


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = _patterns(spark, sf_dir)
    return primers.locate(views.sequences(spark, sf_dir), pool).join(pool, "pattern")


def pattern_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir)


def amplicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return primers.amplicons(_located(spark, sf_dir))


def depth_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = tags.run_totals(tags.fold_names(tags.demote_repeats(views.alignments(spark, sf_dir))))
    return summary.with_violations(summary.depth_table(totals, counts.molecule_counts(views.umi_groups(spark, sf_dir))))


_HITS_WORDS = f"SELECT id, seq, unnest(range(0, length(seq) - {K} + 1)) AS pos FROM pool"
_TAILS = "SELECT id, substr(seq, length(seq) - d - k + 1, k) AS tail, d + 1 AS near FROM pool, range(4, 9) r(k), range(0, 4) q(d) WHERE k + d <= length(seq)"
_LOCATED = f"""{_SEQ}, {_POOL}, wanted AS (
    SELECT substr(seq, 7, 8) AS pattern, min(primer_type) AS primer_type FROM pool GROUP BY 1
), strands AS (
    SELECT pattern, primer_type, '+' AS strand, pattern AS word FROM wanted UNION ALL SELECT pattern, primer_type, '-', {_RC.format("pattern")} FROM wanted
), spots AS (
    SELECT id AS seq_id, pos AS start, substr(seq, pos::INT, 8) AS word FROM (SELECT id, seq, unnest(range(1, 58)) AS pos FROM seqs)
), located AS (
    SELECT pattern, seq_id, strand, start::INT AS start, (start + 7)::INT AS "end", primer_type FROM spots JOIN strands USING (word)
)"""
_TOTALS = """totals AS (
    SELECT sample, count(*) AS total_r1, count(*) FILTER (fwd <> 'no_adapter' AND rev <> 'no_adapter') AS not_na_adapter, count(*) FILTER (ok) AS good_umi,
        count(*) FILTER (mapped) AS mapped, count(*) FILTER (len(genes) > 0) AS assigned, count(*) FILTER (mapped AND ok) AS counted,
        count(*) FILTER (mapped AND ok AND len(genes) > 0) AS counted_assigned
    FROM names WHERE r1 GROUP BY sample
)"""

_SQL = {
    "umi_dedup_counts": f"WITH {_COUNTS} SELECT sample, feature, n FROM counts",
    "raw_read_counts": f"WITH {_GROUPS} SELECT sample, feature, count(*) AS n FROM assigned GROUP BY ALL",
    "umi_group": f"WITH {_GROUPS} SELECT sample, read_id, gene, final_umi AS umi, count(*) OVER (PARTITION BY sample, gene, final_umi) AS umi_count FROM assigned",
    "count_matrix_long": f"WITH {_COUNTS} SELECT s.sample, f.feature, coalesce(n, 0) AS n FROM (SELECT DISTINCT sample FROM groups) s CROSS JOIN (SELECT DISTINCT feature FROM counts) f LEFT JOIN counts c ON c.sample = s.sample AND c.feature = f.feature",
    "mean_relative_abundance": f"WITH {_COUNTS}, depth AS (SELECT sample, sum(n) AS total FROM counts GROUP BY 1) SELECT feature, round(sum(n / total) / (SELECT count(*) FROM depth), 9) AS abundance FROM counts JOIN depth USING (sample) GROUP BY 1",
    "consolidated_reads": f"WITH {_GROUPS} SELECT sample, read_id, array_to_string(list_sort(list_distinct(list_filter(flatten(list(string_split(gene, ','))), lambda g: g <> ''))), '|') AS genes FROM groups GROUP BY ALL",
    "gene_cooccurrence": f"WITH {_GROUPS}, g AS (SELECT DISTINCT sample, read_id, unnest(string_split(gene, ',')) AS gene FROM groups) SELECT a.gene AS gene_a, b.gene AS gene_b, count(*) AS weight FROM g a JOIN g b ON a.sample = b.sample AND a.read_id = b.read_id AND a.gene < b.gene WHERE a.gene LIKE 'G%' AND b.gene LIKE 'G%' GROUP BY ALL",
    "gene_components": f"""WITH RECURSIVE {_GROUPS}, g AS (SELECT DISTINCT sample, read_id, unnest(string_split(gene, ',')) AS gene FROM groups),
        e AS (SELECT DISTINCT a.gene AS a, b.gene AS b FROM g a JOIN g b ON a.sample = b.sample AND a.read_id = b.read_id AND a.gene <> b.gene WHERE a.gene LIKE 'G%' AND b.gene LIKE 'G%'),
        reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)
        SELECT a AS gene, array_to_string(list_sort(list(DISTINCT b)), '|') AS component FROM reach GROUP BY a""",
    "symbol_collapse": f"""WITH {_COUNTS}, named AS (SELECT *, concat('S', string_split(feature, '|')[1]) AS symbol FROM counts),
        width AS (SELECT symbol, count(DISTINCT feature) AS columns FROM named GROUP BY 1)
        SELECT sample, symbol, round_even(sum(n) / any_value(columns), 0)::BIGINT AS n FROM named JOIN width USING (symbol) GROUP BY 1, 2""",
    "log2_cpm": f"WITH {_COUNTS}, depth AS (SELECT sample, sum(n) AS depth FROM counts GROUP BY 1), total AS (SELECT least(avg(depth), 1e6) AS total FROM depth) SELECT sample, feature, round(log2(1 + n / depth * total), 6) AS value FROM counts JOIN depth USING (sample) CROSS JOIN total",
    "tag_fold": f"WITH {_ALIGN} SELECT sample, qname, concat(CASE WHEN len(genes) > 0 THEN array_to_string(genes, ',') ELSE 'Unassigned' END, ',', fwd, '+', rev) AS xf, mapped, len(genes) > 0 AS assigned, ok AS criteria_ok, mapped AND ok AS counted FROM names",
    "tag_run_totals": f"WITH {_ALIGN}, {_TOTALS} SELECT * FROM totals",
    "primer_properties": f"WITH {_SEQ} SELECT id AS seq_id, {_RC.format('seq')} AS rc, (length(seq) - length(translate(seq, 'GC', '')))::INT AS gc FROM seqs",
    "kmer_complement_hits": f"""WITH {_POOL}, w AS (SELECT id, substr(seq, pos::INT + 1, {K}) AS kmer, (length(seq) - {K} - pos)::INT AS d FROM ({_HITS_WORDS}))
        SELECT a.id AS id_1, b.id AS id_2, a.kmer, a.d AS d_1, b.d AS d_2, {_SCORE.format("a.kmer")} / ((1 + a.d) * (1 + b.d)) * CASE WHEN a.id = b.id THEN 2 ELSE 1 END AS score
        FROM w a JOIN w b ON a.kmer = {_RC.format("b.kmer")} AND a.id <= b.id""",
    "pool_complement_hits": f"""WITH {_POOL}, w AS (SELECT id, substr(seq, (length(seq) - d - k + 1)::INT, k::INT) AS kmer, d::INT AS d FROM pool, range(4, 9) r(k), range(0, 60) q(d) WHERE d + k <= length(seq))
        SELECT a.id AS id_1, b.id AS id_2, a.kmer, a.d AS d_1, b.d AS d_2, {_SCORE.format("a.kmer")} / ((1 + a.d) * (1 + b.d)) * CASE WHEN a.id = b.id THEN 2 ELSE 1 END AS score
        FROM w a JOIN w b ON a.kmer = {_RC.format("b.kmer")} AND a.id <= b.id""",
    "primer_dimer_loss": f"""WITH {_POOL}, t AS ({_TAILS}), weights AS (SELECT {_RC.format("tail")} AS tail, sum(1.0::DOUBLE / near) AS weight FROM t GROUP BY 1)
        SELECT id, round(sum({_SCORE.format("tail")} / near * weight), 4) AS loss FROM t JOIN weights USING (tail) GROUP BY 1""",
    "pool_saddle_loss": f"""WITH {_POOL}, t AS (SELECT id, substr(seq, length(seq) - d - k + 1, k) AS tail, d + 1 AS near FROM pool, range(4, 13) r(k), range(0, 3) q(d) WHERE k + d <= length(seq)),
        met AS (SELECT a.id, {_SCORE.format("a.tail")} / (a.near * b.near) * CASE WHEN a.id = b.id THEN 2 ELSE 1 END AS part FROM t a JOIN t b ON a.tail = {_RC.format("b.tail")})
        SELECT id, round(sum(part), 4) AS loss FROM met GROUP BY 1""",
    "pattern_locations": f"WITH {_LOCATED} SELECT * FROM located",
    "amplicons": f"""WITH {_LOCATED} SELECT u.seq_id, u.pattern AS up, u.primer_type AS up_type, u.start AS up_start, u."end" AS up_end, d.pattern AS down, d.primer_type AS down_type, d.start AS down_start, d."end" AS down_end, d."end" - u.start + 1 AS length
        FROM located u JOIN located d ON u.seq_id = d.seq_id AND u.strand = '+' AND d.strand = '-' AND u."end" < d.start""",
    "depth_summary": f"""WITH {_ALIGN}, {_TOTALS}, {_COUNTS}, m AS (SELECT sample, sum(n)::BIGINT AS n_umi, count(*) AS n_genes FROM counts WHERE n > 0 GROUP BY 1),
        t AS (SELECT * FROM totals FULL JOIN m USING (sample))
        SELECT *, array_to_string(list_filter([{", ".join(f"CASE WHEN {a} < {b} THEN '{a}<{b}' END" for a, b in summary.EDGES)}], lambda x: x IS NOT NULL), ',') AS violations FROM t""",
}

_QUERIES = (umi_dedup_counts, raw_read_counts, umi_group, count_matrix_long, mean_relative_abundance, consolidated_reads, gene_cooccurrence, gene_components, symbol_collapse, log2_cpm, tag_fold, tag_run_totals, primer_properties, kmer_complement_hits, pool_complement_hits, primer_dimer_loss, pool_saddle_loss, pattern_locations, amplicons, depth_summary)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
