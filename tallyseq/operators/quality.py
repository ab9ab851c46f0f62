"""Quality of a sequencing run: counts and ratios per sample at each step, and statistics of its reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.operators.tags import NOT_PRIMARY, READ1, READ2, has

#: A base call counts as good from this quality on; qualities are written as characters from ``!`` (0).
GOOD_QUALITY = 30
UMI_LENGTH = 6


def good_ratio(counts: DataFrame) -> DataFrame:
    """Per sample and mate: the share of reads of quality 30 or more, from (sample, read, quality, count)."""
    good = F.sum(F.when(F.col("quality") >= GOOD_QUALITY, F.col("count")).otherwise(0)) / F.sum("count")
    return counts.groupBy("sample", "read").agg(good.alias("ratio"))


def molecule_totals(groups: DataFrame) -> DataFrame:
    """Per sample: rows, distinct (gene, molecule) pairs and genes; unassigned rows count too."""
    pairs = groups.groupBy("sample", "gene", "unique_id").agg(F.count("*").alias("rows"))
    genes = pairs.groupBy("sample", "gene").agg(F.sum("rows").alias("rows"), F.count("*").alias("pairs"))
    return genes.groupBy("sample").agg(F.sum("rows").alias("num_counts"), F.sum("pairs").alias("num_umi"), F.count("*").alias("num_genes"))


def mapped_reads(star: DataFrame) -> DataFrame:
    """Per sample: reads of all rows of the aligner's gene table but the unmapped one."""
    return star.where("not gene_id <=> 'N_unmapped'").groupBy("sample").agg(F.sum("unstranded").alias("num_reads_mapped"))


def primer_reads(reads: DataFrame) -> DataFrame:
    """Per sample: reads with both primers, and those of them with two whole UMIs."""
    both = (F.col("primer_fwd") != "no_adapter") & (F.col("primer_rev") != "no_adapter")
    whole = lambda c: (F.length(c) == UMI_LENGTH) & ~F.col(c).contains("N")
    return reads.groupBy("sample").agg(F.count_if(both).alias("num_reads_primer"), F.count_if(both & whole("umi5") & whole("umi3")).alias("num_reads_good_umi"))


def run_metrics(raw: DataFrame, trimmed: DataFrame, reads: DataFrame, star: DataFrame, groups: DataFrame, qualities: DataFrame) -> DataFrame:
    """One row per sample of any source with ten metrics; a source that lacks the sample leaves its metrics null.

    ``raw`` and ``trimmed``: sample, read, num_seqs. ``reads``: sample, primer_fwd, primer_rev, umi5, umi3.
    ``star``: sample, gene_id, unstranded. ``groups``: sample, gene, unique_id. ``qualities``: sample, read, quality, count.
    """
    first = lambda df, name: df.where("read = 'r1'").groupBy("sample").agg(F.max("num_seqs").alias(name))
    ratios = good_ratio(qualities).groupBy("sample").agg(*[F.max(F.when(F.col("read") == r, F.col("ratio"))).alias(f"q30_{r}") for r in ("r1", "r2")])
    out = first(raw, "num_reads_raw")
    for more in (first(trimmed, "num_reads_qc"), primer_reads(reads), mapped_reads(star), molecule_totals(groups), ratios):
        out = out.join(more, "sample", "full")
    return out


def mate_counts(records: DataFrame) -> DataFrame:
    """Per sample: primary records of either mate, and whether they are as many."""
    primary = ~has(F.col("flag"), NOT_PRIMARY)
    n1, n2 = (F.count_if(primary & has(F.col("flag"), bit)) for bit in (READ1, READ2))
    return records.groupBy("sample").agg(n1.alias("n_first"), n2.alias("n_second")).withColumn("paired", F.col("n_first") == F.col("n_second"))


def repeated_reads(groups: DataFrame) -> DataFrame:
    """Reads that stand more than once in a sample's table of grouped reads, where each should stand once."""
    return groups.groupBy("sample", "read_id").agg(F.count("*").alias("n")).where("n > 1")


def assert_unique_reads(groups: DataFrame) -> None:
    """Raise with an example if a read stands more than once."""
    if (one := repeated_reads(groups).first()) is not None:
        raise ValueError(f"read {one['read_id']} of sample {one['sample']} stands {one['n']} times")


def base_statistics(reads: DataFrame, seq: str, qual: str) -> DataFrame:
    """Per sample: reads, bases, shortest, mean and longest read, percent of G and C and of bases of quality 20 and 30 or more."""
    of = lambda marks: F.sum(F.length(seq) - F.length(F.translate(F.upper(F.col(seq)), marks, "")))
    from_quality = lambda q: F.sum(F.regexp_count(qual, F.lit(f"[\\x{33 + q:02X}-\\x7E]")))
    percent = lambda part: F.round(100 * part / F.sum(F.length(seq)), 2)
    n = F.length(seq)
    return reads.groupBy("sample").agg(
        F.count("*").alias("num_seqs"),
        F.sum(n).alias("sum_len"),
        F.min(n).cast("long").alias("min_len"),
        F.round(F.avg(n), 1).alias("avg_len"),
        F.max(n).cast("long").alias("max_len"),
        percent(from_quality(20)).alias("q20"),
        percent(from_quality(30)).alias("q30"),
        percent(of("GC")).alias("gc"),
    )


def quality_histogram(report: Column) -> Column:
    """(quality, count) structs of the read-quality section of a report; a report without that section raises."""
    found = F.regexp_extract(report, r"(?s)>>Per sequence quality scores[^\n]*\n(.*?)>>END_MODULE", 1)
    section = F.when(found != "", found).otherwise(F.raise_error(F.lit("no section of read qualities")))
    lines = F.filter(F.split(section, "\n"), lambda x: x.rlike(r"^[0-9]"))
    return F.transform(lines, lambda x: F.struct(F.split_part(x, F.lit("\t"), F.lit(1)).cast("int").alias("quality"), F.split_part(x, F.lit("\t"), F.lit(2)).cast("double").alias("count")))
