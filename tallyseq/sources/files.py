"""Readers of the domain's text formats as DataFrames; compressed files are read as they are."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GROUP_SCHEMA = "read_id string, contig string, position long, gene string, umi string, umi_count long, final_umi string, final_umi_count long, unique_id long"
GTF_SCHEMA = "seqname string, source string, feature string, start long, `end` long, score string, strand string, frame string, attribute string"
SAM_FIELDS = ("qname", "flag", "contig", "pos", "mapq", "cigar", "mate_contig", "mate_pos", "template_length", "seq", "qual")


def natural_key(path: str) -> list:
    """Digits compare as numbers, the rest as text."""
    return [(0, int(part), "") if part.isdigit() else (1, 0, part) for part in re.split(r"(\d+)", path) if part]


def expand_paths(spark: SparkSession, arg: str | list[str], suffixes: tuple[str, ...] = ()) -> list[str]:
    """Files of patterns, in the patterns' order and naturally sorted within each; a folder stands for its files.

    Listing goes through Hadoop's file systems, so it works wherever Spark reads.
    """
    patterns = [arg] if isinstance(arg, str) else arg
    if not isinstance(patterns, list | tuple) or not all(isinstance(p, str) for p in patterns):
        raise TypeError("a path or a list of paths is wanted")
    found: list[str] = []
    for pattern in patterns:
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        entries = [*(fs.globStatus(path) or [])]
        if len(entries) == 1 and entries[0].isDirectory() and entries[0].getPath().getName() == path.getName():
            entries = [*fs.listStatus(path)]
        names = {e.getPath().toString() for e in entries if not suffixes or (e.isFile() and e.getPath().getName().endswith(suffixes))}
        found += sorted(names - {*found}, key=natural_key)
    if not found:
        raise FileNotFoundError(f"no files match {patterns}")
    return found


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def sample_before_dot(path: Column) -> Column:
    """The sample of a table of grouped reads: the file's name up to its first dot."""
    return F.substring_index(file_name(path), ".", 1)


def sample_before_mark(path: Column) -> Column:
    """The sample of a file of reads: its name up to the first dot or underscore."""
    return F.regexp_extract(file_name(path), r"^([^._]*)", 1)


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their file and their number in it (from 0), for files of any size, split or not.

    A scan's rows are numbered within each split; lines per split are counted first, so a line's
    number is the sum over the splits before it and its place in its own.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(offsets, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line"), "value")


def read_fastq(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Reads: file, ord (from 0), read_id, comment, seq, qual."""
    lines = read_lines(spark, paths).withColumn("ord", F.expr("line div 4"))
    part = lambda k: F.max(F.when(F.col("line") % 4 == k, F.rtrim("value")))
    rows = lines.groupBy("file", "ord").agg(part(0).alias("header"), part(1).alias("seq"), part(3).alias("qual")).where("header <> ''")
    header = F.expr("substring(header, 2)")
    named = rows.select("file", "ord", F.split_part(header, F.lit(" "), F.lit(1)).alias("read_id"), F.regexp_extract(header, r"^\S+ (.*)$", 1).alias("comment"), "seq", "qual", "header")
    ok = F.col("header").startswith("@") & (F.length("seq") == F.length("qual"))
    return named.withColumn("read_id", F.when(ok, F.col("read_id")).otherwise(F.raise_error(F.concat(F.lit("not a read: "), F.col("header"))))).drop("header")


def read_pairs(spark: SparkSession, first: list[str], second: list[str]) -> DataFrame:
    """Pairs by sample and place; reads without a mate and mates of another name raise."""
    one, two = (read_fastq(spark, p).withColumn("sample", sample_before_mark(F.col("file"))).drop("file") for p in (first, second))
    names = {"comment": "comment{}", "seq": "r{}_seq", "qual": "r{}_qual", "read_id": "id{}"}
    one, two = (d.withColumnsRenamed({a: b.format(k) for a, b in names.items()}) for k, d in ((1, one), (2, two)))
    rows = one.join(two, ["sample", "ord"], "full")
    same = F.when(F.col("id1").eqNullSafe(F.col("id2")), F.col("id1")).otherwise(F.raise_error(F.concat(F.lit("mates differ: "), F.coalesce("id1", F.lit("-")), F.lit(" "), F.coalesce("id2", F.lit("-")))))
    return rows.select("sample", "ord", same.alias("read_id"), "comment1", "comment2", "r1_seq", "r1_qual", "r2_seq", "r2_qual")


def read_fasta(spark: SparkSession, paths: list[str]) -> DataFrame:
    """seq_id, description, seq (upper case, no white space); of equal ids the last in path order and file order stays."""
    rows = spark.read.option("lineSep", "\n>").text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", r"^\s*>", "").alias("value"))
    head, body = F.rtrim(F.regexp_extract("value", r"^([^\r\n]*)", 1)), F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s", "")
    seqs = rows.where(F.col("value").rlike(r"\S")).select(F.split_part(head, F.lit(" "), F.lit(1)).alias("seq_id"), head.alias("description"), F.upper(body).alias("seq"), F.struct("file", "block", "at").alias("place"))
    return seqs.groupBy("seq_id").agg(F.max_by(F.struct("description", "seq"), "place").alias("s")).select("seq_id", "s.*")


def read_sam(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Alignment records in order ``ord``: the fixed fields (positions from 0), ``tags`` and the kinds of their values; unmapped ones stay."""
    rows = spark.read.text(paths).where(~F.col("value").rlike(r"^@[A-Z]{2}\t|^\s*$")).select(F.monotonically_increasing_id().alias("ord"), F.split("value", "\t").alias("f"))
    fields = {n: F.col("f")[i] for i, n in enumerate(SAM_FIELDS)}
    fields |= {n: fields[n].cast("int") for n in ("flag", "mapq")} | {n: fields[n].cast("long") for n in ("pos", "mate_pos", "template_length")}
    fields |= {n: fields[n] - 1 for n in ("pos", "mate_pos")}
    found = F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0)))
    entries = lambda value: F.map_from_entries(F.transform(found, lambda t: F.struct(F.substring(t, 1, 2).alias("key"), value(t).alias("value"))))
    tags, kinds = entries(lambda t: F.substr(t, F.lit(6))), entries(lambda t: F.substring(t, 4, 1))
    return rows.select("ord", *[c.alias(n) for n, c in fields.items()], tags.alias("tags"), kinds.alias("tag_types"))


def sam_header(spark: SparkSession, path: str) -> str:
    """The header's lines of one file, which stand at its beginning."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"^@[A-Z]{2}\t")).select("value", F.monotonically_increasing_id().alias("at"))
    return "".join(f"{r['value']}\n" for r in lines.orderBy("at").collect())


def read_groups(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Tables of grouped reads with their sample."""
    rows = spark.read.schema(GROUP_SCHEMA).option("enforceSchema", False).csv(paths, sep="\t", header=True)
    return rows.withColumn("sample", sample_before_dot(F.col("_metadata.file_path")))


def read_gtf(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Annotation rows with ``gene_id`` (no version) and ``gene_name``."""
    rows = spark.read.schema(GTF_SCHEMA).csv(paths, sep="\t", comment="#", quote="")
    pick = lambda key: F.regexp_extract("attribute", f'{key} "(.*?)";', 1)
    return rows.withColumns({"gene_id": F.substring_index(pick("gene_id"), ".", 1), "gene_name": pick("gene_name")})


def gene_symbols(gtf: DataFrame) -> DataFrame:
    """One symbol per gene id; an id with two symbols raises."""
    found = gtf.where("gene_id <> '' and gene_name <> ''").groupBy("gene_id").agg(F.min("gene_name").alias("symbol"), F.max("gene_name").alias("other"))
    return found.select("gene_id", F.when(F.col("symbol") == F.col("other"), F.col("symbol")).otherwise(F.raise_error(F.concat(F.lit("two symbols of "), F.col("gene_id")))).alias("symbol"))


def read_first_mate_counts(spark: SparkSession, paths: list[str], name: str = "reads") -> DataFrame:
    """Reads per sample from tables of read statistics (columns ``file`` and ``num_seqs``), first mates only."""
    rows = spark.read.csv(paths, sep="\t", header=True)
    sample = F.split_part(F.split_part(file_name(F.col("file")), F.lit("."), F.lit(1)), F.lit("_"), F.lit(1))
    return rows.where(F.col("file").contains("R1_001") | F.col("file").contains("_1.")).select(sample.alias("sample"), F.col("num_seqs").cast("long").alias(name))


def read_aligner_logs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Input reads of each sample, by the first line of its log that tells them; a sample is the folder of its log."""
    logs = spark.read.text(paths, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("sample"), F.regexp_extract("value", r"Number of input reads\s*\|\s*(\d+)", 1).alias("n"))
    return logs.where("n <> ''").groupBy("sample").agg(F.min(F.col("n").cast("long")).alias("long_read"))


def read_tagger_logs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``sample`` and ``metrics`` (a map) of summary lines; the last line of a sample counts, a sample named ``-`` raises."""
    lines = read_lines(spark, paths).where(F.col("value").startswith("SUMMARY "))
    found = lines.select("file", "line", F.expr("str_to_map(substring(trim(value), 9), ' ', '=')").alias("m")).withColumn("sample", F.col("m")["cell_tag"])
    named = F.when(F.col("sample") == "-", F.raise_error(F.lit("a summary line names no sample"))).otherwise(F.col("sample"))
    last = found.withColumn("sample", named).groupBy("sample").agg(F.max_by("m", F.struct("file", "line")).alias("m"))
    return last.select("sample", F.transform_values(F.map_filter("m", lambda k, _: k != "cell_tag"), lambda _, v: v.cast("long")).alias("metrics"))


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A written count matrix in long form; the separator follows the extension."""
    wide = spark.read.csv(path, sep="," if re.search(r"\.csv(\.gz)?$", path) else "\t", header=True)
    first, *features = wide.columns
    long = wide.unpivot([f"`{first}`"], [f"`{c}`" for c in features], "feature", "n")
    return long.select(F.col(f"`{first}`").alias("sample"), F.regexp_replace("feature", "^`|`$", "").alias("feature"), F.col("n").cast("long").alias("n"))
