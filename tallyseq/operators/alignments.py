"""Alignments in order of place or by name, and their genes by strand, overlap and number of hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.operators.intervals import merged, overlaps
from tallyseq.operators.ranks import global_rank

_PLACE = ["contig", "start", "end", "strand"]
#: Bits of a bin of the index of a sorted table.
INDEX_BITS = 14


def by_place(rows: DataFrame, *ties: str, files: int | None = None) -> DataFrame:
    """Records in ranges of (contig, start, ``ties``), sorted in each: the files of the result are in order one after another.

    Records without a contig come last. The ties are part of the ranges, so a crowded place is dealt to several tasks. ``files`` is the number of ranges, by default Spark's.
    """
    order = [F.col("contig").asc_nulls_last(), F.col("start").asc_nulls_last(), *[F.col(t) for t in ties]]
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def collated(rows: DataFrame, *order: str) -> DataFrame:
    """All records of a name one after another, by ``order`` among themselves; names are in no order."""
    return rows.repartition("qname").sortWithinPartitions("qname", *order)


def place_index(rows: DataFrame, *ties: str) -> DataFrame:
    """(contig, bin, first, records): the number in the sorted order of a bin's first record, and how many begin in the bin.

    A record counts in the bin of its start; unplaced records have no bin.
    """
    ranked = global_rank(rows.select("contig", "start", *ties), F.col("contig").asc_nulls_last(), F.col("start").asc_nulls_last(), *[F.col(t) for t in ties])
    placed = ranked.where("contig is not null and start is not null").withColumn("bin", F.shiftright("start", INDEX_BITS))
    return placed.groupBy("contig", "bin").agg(F.min("rank").alias("first"), F.count("*").alias("records"))


def _hits() -> Column:
    return F.greatest(F.coalesce("hits", F.lit(1)), F.lit(1)).alias("hits")


def _strands_fit(strand: int) -> Column:
    if strand not in (0, 1, 2):
        raise ValueError("strand is 0 (any), 1 (the gene's own) or 2 (the other one)")
    same = F.col("strand") == F.col("gene_strand")
    return F.lit(True) if strand == 0 else same if strand == 1 else ~same


def assign_features(rows: DataFrame, exons: DataFrame, strand: int = 1, overlap: bool = True, multiple: bool = True, fraction: bool = False) -> DataFrame:
    """Each alignment with ``status``, its sorted ``genes`` and the ``weight`` that it gives each of them.

    ``rows``: read_id, contig, start, end, strand, hits (alignments of its read); ``exons``: gene, contig, start, end, strand. A read with
    several hits counts only if ``multiple``, one with several genes only if ``overlap``. With ``fraction`` an alignment
    gives each gene 1 / (hits * genes), else 1. Strands that are null fit no gene unless any fits. Rows are told apart by all their columns, equal rows come once each.
    """
    return _told(rows.select("read_id", *_PLACE, _hits()), exons, strand, overlap, multiple, fraction)


def feature_counts(rows: DataFrame, exons: DataFrame, strand: int = 1, overlap: bool = True, multiple: bool = True, fraction: bool = False) -> DataFrame:
    """``feature_totals`` of ``assign_features``, where alignments of one place and number of hits are counted before they meet a gene."""
    counted = rows.select(*_PLACE, _hits()).groupBy(*_PLACE, "hits").agg(F.count("*").alias("alignments"))
    told = _told(counted if multiple else counted.where("hits = 1"), exons, strand, overlap, multiple, fraction)
    return feature_totals(told.withColumn("weight", F.col("weight") * F.col("alignments")))


def _told(numbered: DataFrame, exons: DataFrame, strand: int, overlap: bool, multiple: bool, fraction: bool) -> DataFrame:
    met = overlaps(numbered.select("contig", "start", "end", "strand").distinct(), merged(exons.where("gene is not null").select("contig", "start", "end", "gene", F.col("strand").alias("gene_strand")), "contig", "gene", "gene_strand"))
    fits = met.where(_strands_fit(strand)).groupBy(F.col("contig").alias("of_contig"), F.col("left_start").alias("of_start"), F.col("left_end").alias("of_end"), F.col("strand").alias("of_strand")).agg(F.array_sort(F.collect_set("gene")).alias("genes"))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ("contig", "start", "end", "strand")]
    told = numbered.join(fits, same[0] & same[1] & same[2] & same[3], "left").select(*numbered.columns, F.coalesce("genes", F.array().cast("array<string>")).alias("genes"))
    n = F.size("genes")
    status = F.when((F.col("hits") > 1) & F.lit(not multiple), "multiple").when(n == 0, "none").when((n > 1) & F.lit(not overlap), "ambiguous").otherwise("assigned")
    weight = 1 / (F.col("hits") * n) if fraction else F.lit(1.0)
    return told.withColumn("status", status).withColumn("weight", F.when(F.col("status") == "assigned", weight).otherwise(0.0))


def feature_totals(assigned: DataFrame) -> DataFrame:
    """Weight per gene over all alignments."""
    rows = assigned.where("status = 'assigned'").select(F.explode("genes").alias("gene"), "weight")
    return rows.groupBy("gene").agg(F.sum("weight").alias("n"))
