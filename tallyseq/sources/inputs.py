"""Smaller inputs of the domain: paths and formats, interleaved reads, tables with checked columns, quality reports."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.operators.quality import quality_histogram
from tallyseq.sources.files import file_name, read_fasta, read_lines
from tallyseq.sources.workbooks import zipped_reports

#: Endings of files of reads and of alignments.
READ_ENDINGS = (".fq.gz", ".fastq.gz", ".fq", ".fastq")
ALIGNMENT_ENDINGS = (".bam", ".sam")
#: Marks of a first mate and of its second one; the first mark that a path holds counts.
MATE_MARKS = (("_R1.", "_R2."), (".R1.", ".R2."), ("_1.", "_2."), (".1.", ".2."), ("_R1_", "_R2_"), ("_r1.", "_r2."))
#: Endings of tables of grouped reads, the longest first.
GROUP_ENDINGS = (".group.tsv.gz", ".group.tsv", ".tsv.gz", ".tsv")
#: Columns of tables, by the names that the operators use.
PRIMER_INFO = {
    "amplicon_index": "amplicon_index",
    "geneID": "gene_id",
    "geneSymbol": "gene_symbol",
    "transcriptID": "transcript_id",
    "L_seq": "l_seq",
    "L_start": "l_start",
    "R_seq": "r_seq",
    "R_start": "r_start",
    "amplicon_size": "amplicon_size",
}
SELECTED = {"transcriptID": "transcript_id", "primerIndex": "primer_index", "sequenceLeft": "l_seq", "sequenceRight": "r_seq"}


def is_reads(path: str) -> bool:
    return path.endswith(READ_ENDINGS)


def is_alignment(path: str) -> bool:
    return path.endswith(ALIGNMENT_ENDINGS)


def check_formats(paths: list[str], allowed: str) -> None:
    """Raise at the first path that is not of the ``allowed`` format: fastq, alignment or both."""
    tests = {"fastq": (is_reads,), "alignment": (is_alignment,), "both": (is_reads, is_alignment)}
    if allowed not in tests:
        raise ValueError(f"unknown format: {allowed}")
    for path in paths:
        if not any(test(path) for test in tests[allowed]):
            raise ValueError(f"not a file of {allowed}: {path}")


def second_mate(path: str) -> str:
    """The path of the second mate's file, from the first's."""
    for one, two in MATE_MARKS:
        if one in path:
            return path.replace(one, two, 1)
    stem, _, ending = path.rpartition(".")
    return f"{stem}_R2.{ending}"


def sample_of_groups(path: Column) -> Column:
    """The sample of a table of grouped reads: its name without the longest known ending, or else without its last suffix."""
    name = file_name(path)
    endings = "|".join(map(re.escape, GROUP_ENDINGS))
    return F.when(name.rlike(f"(?:{endings})$"), F.regexp_replace(name, f"(?:{endings})$", "")).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))


def read_interleaved(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Pairs from files in which the mates follow one another, eight lines a pair, up to the first empty header.

    file, ord, read_id, comment1, r1_seq, r1_qual, comment2, r2_seq, r2_qual; mates of different names raise.
    """
    lines = read_lines(spark, paths).withColumn("ord", F.expr("line div 8"))
    part = lambda k: F.max(F.when(F.col("line") % 8 == k, F.rtrim("value")))
    names = ("h1", "r1_seq", "r1_qual", "h2", "r2_seq", "r2_qual")
    rows = lines.groupBy("file", "ord").agg(*[part(k).alias(n) for k, n in zip((0, 1, 3, 4, 5, 7), names, strict=True)])
    ends = rows.where("coalesce(h1, '') = ''").groupBy("file").agg(F.min("ord").alias("__end"))
    rows = rows.join(ends, "file", "left").where("__end is null or ord < __end")
    read_id = lambda h: F.regexp_extract(h, r"^@(\S*)", 1)
    comment = lambda h: F.regexp_extract(h, r"^\S+ (.*)$", 1)
    same = F.when(read_id("h1") == read_id("h2"), read_id("h1")).otherwise(F.raise_error(F.concat(F.lit("mates differ: "), F.col("h1"), F.lit(" "), F.coalesce("h2", F.lit("-")))))
    return rows.select("file", "ord", same.alias("read_id"), comment("h1").alias("comment1"), "r1_seq", "r1_qual", comment("h2").alias("comment2"), "r2_seq", "r2_qual")


def read_two_columns(spark: SparkSession, path: str) -> DataFrame:
    """``key``, ``n`` of a table with one value column; another number of columns raises."""
    rows = spark.read.csv(path, sep="\t", header=True)
    if len(rows.columns) != 2:
        raise ValueError(f"two columns are wanted, found {rows.columns}")
    return rows.toDF("key", "n").withColumn("n", F.col("n").cast("long"))


def read_gene_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of genes; it has a column ``gene``."""
    rows = spark.read.csv(path, sep="\t", header=True)
    if "gene" not in rows.columns:
        raise ValueError(f"no column gene in {rows.columns}")
    return rows


def renamed(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """The named columns under their new names; missing ones raise."""
    if missing := [c for c in names if c not in rows.columns]:
        raise ValueError(f"missing columns: {missing}")
    return rows.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])


def read_primer_info(spark: SparkSession, path: str) -> DataFrame:
    rows = renamed(spark.read.csv(path, sep="\t", header=True), PRIMER_INFO)
    return rows.withColumns({c: F.col(c).cast("int") for c in ("l_start", "r_start", "amplicon_size")})


def selected_pairs(rows: DataFrame) -> DataFrame:
    """Selected pairs by their column names, or else by place: the first four columns."""
    if all(c in rows.columns for c in SELECTED):
        return renamed(rows, SELECTED)
    if len(rows.columns) < 4:
        raise ValueError("selected pairs have four columns at least")
    return rows.select(rows.columns[:4]).toDF(*SELECTED.values())


def read_gene_reads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """sample (the table's folder), gene_id, unstranded, forward, reverse of the aligner's tables without header."""
    rows = spark.read.schema("gene_id string, unstranded long, forward long, reverse long").csv(paths, sep="\t")
    return rows.withColumn("sample", F.element_at(F.split("_metadata.file_path", "/"), -2))


def read_primer_names(spark: SparkSession, path: str) -> DataFrame:
    """``name`` of primers: ids of a file of sequences, or the first column of a table with a header; other endings raise."""
    if path.endswith((".fasta", ".fa", ".fna")):
        return read_fasta(spark, [path]).select(F.col("seq_id").alias("name"))
    if path.endswith((".csv", ".tsv", ".txt")):
        rows = spark.read.csv(path, sep="," if path.endswith(".csv") else "\t", header=True)
        return rows.select(F.col(f"`{rows.columns[0]}`").alias("name"))
    raise ValueError(f"unknown format of primers: {path}")


def read_quality_reports(spark: SparkSession, paths: list[str]) -> DataFrame:
    """sample, read, quality, count of text reports of read qualities, one folder a report: ``<sample>_..._R1_001_fastqc/fastqc_data.txt``; a zip holds such folders."""
    zips, plain = [p for p in paths if p.endswith(".zip")], [p for p in paths if not p.endswith(".zip")]
    parts = [zipped_reports(spark, zips)] if zips else []
    parts += [spark.read.text(plain, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder"), "value")] if plain or not zips else []
    rows = reduce(DataFrame.unionByName, parts).select("folder", F.explode(quality_histogram(F.col("value"))).alias("q"))
    read = F.when(F.col("folder").contains("_R1_001"), "r1").otherwise("r2")
    return rows.select(F.split_part("folder", F.lit("_"), F.lit(1)).alias("sample"), read.alias("read"), "q.quality", "q.count")


def read_reference(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Sequences that must be there: a file without any raises."""
    rows = read_fasta(spark, paths)
    if not rows.limit(1).count():
        raise ValueError(f"no sequences in {paths}")
    return rows


def reference_path(root: str, own: str | None, species: str | None, name: str = "transcripts.fa.gz") -> str:
    """A reference of one's own wins; else that of the species below ``root``; neither raises."""
    if own:
        return own
    if species:
        return f"{root.rstrip('/')}/{species}/{name}"
    raise ValueError("a reference or a species is wanted")
