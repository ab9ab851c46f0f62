"""Registered queries on alignments: genes by strand and hits, order by place, binary files, with SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.operators import alignments
from tallyseq.session import shared_dir, spread
from tallyseq.sources import bam, files, views


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '_', l_linenumber) AS read_id", "concat('c', l_suppkey % 5) AS contig", "l_orderkey * 37 % 100000 AS start", "l_orderkey * 37 % 100000 + 99 AS end",
        "CASE WHEN l_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand", "cast(l_linenumber % 3 + 1 AS int) AS hits",
    )


def _exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "part").selectExpr(
        "concat('G', p_partkey % 40) AS gene", "concat('c', p_partkey % 5) AS contig", "p_partkey * 91 % 100000 AS start", "p_partkey * 91 % 100000 + p_partkey % 300 AS end", "CASE WHEN p_partkey % 3 = 0 THEN '+' ELSE '-' END AS strand"
    )


def stranded_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes of each alignment on its own strand; alignments of several genes count in all."""
    found = alignments.assign_features(_rows(spark, sf_dir), _exons(spark, sf_dir), 1)
    return found.select("read_id", "status", F.array_join("genes", ",").alias("genes"))


def fraction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per gene of the other strand, in fractions of hits and genes."""
    found = alignments.feature_totals(alignments.assign_features(_rows(spark, sf_dir), _exons(spark, sf_dir), 2, fraction=True))
    return found.select("gene", F.round("n", 6).alias("n"))


def unique_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per gene on any strand of alignments with one hit and one gene."""
    found = alignments.feature_counts(_rows(spark, sf_dir), _exons(spark, sf_dir), 0, overlap=False, multiple=False)
    return found.select("gene", F.col("n").cast("long").alias("n"))


def place_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.place_index(_rows(spark, sf_dir), "read_id")


_HEADER = "".join(f"@SQ\tSN:c{k}\tLN:100000\n" for k in range(5))
_RECORD = {
    "qname": "concat(l_orderkey, '_', l_linenumber)",
    "flag": "l_linenumber % 4 * 64 + CASE WHEN l_partkey % 11 = 0 THEN 4 ELSE 0 END",
    "contig": "CASE WHEN l_partkey % 11 = 0 THEN '*' ELSE concat('c', l_suppkey % 5) END",
    "pos": "CASE WHEN l_partkey % 11 = 0 THEN -1 ELSE l_orderkey * 37 % 100000 END",
    "cigar": "CASE WHEN l_partkey % 11 = 0 THEN '*' ELSE concat(l_suppkey % 9 + 1, 'S', 10, 'M') END",
    "seq": "concat(repeat('T', CAST(l_suppkey % 9 + 1 AS INT)), 'ACGTNACGTA')",
    "qual": "CASE WHEN l_linenumber = 3 THEN '*' ELSE repeat('F', CAST(l_suppkey % 9 + 11 AS INT)) END",
    "hits": "l_orderkey - 1000",
    "gene": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE concat('G', l_partkey % 40) END",
}


def binary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments written as binary files and read from them in splits."""
    rows = spread(views.table(spark, sf_dir, "lineitem"), "l_orderkey").selectExpr(*[f"{c} AS {n}" for n, c in _RECORD.items()])
    tags = F.map_filter(F.create_map(F.lit("NH"), F.col("hits").cast("string"), F.lit("XT"), F.col("gene")), lambda _, v: v.isNotNull())
    whole = rows.withColumns({"mapq": F.lit(60), "mate_contig": F.lit("*"), "mate_pos": F.lit(-1), "template_length": F.lit(0), "tags": tags, "tag_types": F.create_map(F.lit("NH"), F.lit("i"))})
    path = f"{shared_dir(spark)}/tallyseq-{uuid.uuid4().hex}"
    bam.write_bam(whole, path, _HEADER)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    found = bam.read_bam(spark, files.expand_paths(spark, path, (".bam",)), 1 << 20)
    return found.select("qname", "flag", "contig", "pos", "cigar", "seq", "qual", F.element_at("tags", "NH").cast("long").alias("hits"), F.element_at("tags", "XT").alias("gene"))


_BASE = """r AS (SELECT concat(l_orderkey, '_', l_linenumber) AS read_id, concat('c', l_suppkey % 5) AS contig, l_orderkey * 37 % 100000 AS s, CASE WHEN l_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_linenumber % 3 + 1 AS hits, row_number() OVER () AS n FROM lineitem),
x AS (SELECT concat('G', p_partkey % 40) AS gene, concat('c', p_partkey % 5) AS contig, p_partkey * 91 % 100000 AS s, p_partkey * 91 % 100000 + p_partkey % 300 AS e, CASE WHEN p_partkey % 3 = 0 THEN '+' ELSE '-' END AS strand FROM part)"""


def _genes(fits: str) -> str:
    return f"{_BASE}, g AS (SELECT r.n, read_id, hits, list_sort(list(DISTINCT gene) FILTER (gene IS NOT NULL)) AS genes FROM r LEFT JOIN x ON r.contig = x.contig AND r.s <= x.e AND x.s <= r.s + 99 AND {fits} GROUP BY ALL)"


_SQL = {
    "binary_round_trip": f"SELECT {', '.join(f'{c} AS {n}' for n, c in _RECORD.items())} FROM lineitem",
    "stranded_assignment": f"WITH {_genes('r.strand = x.strand')} SELECT read_id, CASE WHEN genes IS NULL THEN 'none' ELSE 'assigned' END AS status, coalesce(array_to_string(genes, ','), '') AS genes FROM g",
    "fraction_counts": f"WITH {_genes('r.strand <> x.strand')} SELECT gene, round(sum(1.0::DOUBLE / (hits * len(genes))), 6) AS n FROM g, unnest(genes) AS t(gene) GROUP BY gene",
    "unique_counts": f"WITH {_genes('true')} SELECT genes[1] AS gene, count(*) AS n FROM g WHERE hits = 1 AND len(genes) = 1 GROUP BY 1",
    "place_index": f"""
WITH {_BASE}, ranked AS (SELECT contig, s // {1 << alignments.INDEX_BITS} AS bin, row_number() OVER (ORDER BY contig, s, read_id) - 1 AS rank FROM r)
SELECT contig, bin, min(rank) AS first, count(*) AS records FROM ranked GROUP BY contig, bin
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (stranded_assignment, fraction_counts, unique_counts, place_index, binary_round_trip)}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
