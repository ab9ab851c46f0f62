"""Reads, sequences, alignments and matrices as text; each writer makes a folder of parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq import __version__
from tallyseq.sources.files import SAM_FIELDS


def write_fastq(reads: DataFrame, path: str, seq: str = "seq", qual: str = "qual", comment: str = "comment") -> None:
    """``read_id``, comment, sequence and qualities as gzip parts; mates written from rows in one order stay in step."""
    head = F.concat(F.lit("@"), F.col("read_id"), F.when(F.coalesce(comment, F.lit("")) != "", F.concat(F.lit(" "), F.col(comment))).otherwise(F.lit("")))
    reads.select(F.concat_ws("\n", head, F.col(seq), F.lit("+"), F.col(qual))).write.text(path, compression="gzip")


def write_fasta(seqs: DataFrame, path: str, description: Column | None = None) -> None:
    head = F.concat(F.lit(">"), F.col("seq_id"), *([F.lit(" "), description] if description is not None else []))
    seqs.select(F.concat_ws("\n", head, F.col("seq"))).write.text(path)


def write_short_primers(records: DataFrame, path: str) -> None:
    """Named primers (``record_id``, ``seq``) as sequences, without a version."""
    write_fasta(records.select(F.col("record_id").alias("seq_id"), F.upper("seq").alias("seq")), path)


def write_regions(regions: DataFrame, path: str) -> None:
    """The amplicons of ``amplicon_regions`` that are whole, under their primer's index and description."""
    ok = regions.where("status = 'ok'")
    write_fasta(ok.select(F.col("primer_index").alias("seq_id"), F.col("region").alias("seq"), "description"), path, F.col("description"))


def write_sam(records: DataFrame, path: str, header: str = "") -> None:
    """Records with their tags in the order of names, each of its kind in ``tag_types``, else text (``Z``).

    The header's lines, if any, are a part before the records' parts: all parts one after another are one whole file.
    """
    fields = [F.col(n) + 1 if n in ("pos", "mate_pos") else F.col(n) for n in SAM_FIELDS]
    kinds = F.col("tag_types") if "tag_types" in records.columns else F.lit(None).cast("map<string,string>")
    tags = F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit(":"), F.coalesce(F.element_at(kinds, e["key"]), F.lit("Z")), F.lit(":"), e["value"]))
    lines = records.select(F.concat_ws("\t", *[c.cast("string") for c in fields], tags).alias("value"))
    if header:
        lines = records.sparkSession.createDataFrame([(header.rstrip("\n"),)], "value string").coalesce(1).union(lines)
    lines.write.text(path)


def write_matrix(counts: DataFrame, path: str, label: str | None = None, most_features: int = 100_000) -> None:
    """A sample x feature table, one row per sample; holes are 0. More columns than ``most_features`` raise.

    ``label`` is the first cell of the header, by default the program and its version.
    """
    label = label or f"tallyseq {__version__}"
    kinds = (".tsv", ".txt", ".tsv.gz", ".txt.gz"), (".csv", ".csv.gz")
    if not path.endswith(kinds[0] + kinds[1]):
        raise ValueError(f"unknown extension: {path}")
    features = [r[0] for r in counts.select("feature").distinct().orderBy("feature").limit(most_features + 1).collect()]
    if len(features) > most_features:
        raise ValueError(f"more than {most_features} features do not fit a wide table")
    spark = counts.sparkSession
    spark.conf.set("spark.sql.pivotMaxValues", max(10_000, most_features))
    wide = counts.groupBy("sample").pivot("feature", features).agg(F.sum("n")).na.fill(0).orderBy("sample").withColumnRenamed("sample", label)
    wide.write.csv(path, sep="," if path.endswith(kinds[1]) else "\t", header=True, compression="gzip" if path.endswith(".gz") else "none")
