"""Command line: ``python -m tallyseq matrix|read-stats|summary|assign|tags|subset|panel|product|order|pools|recover|rarefy|correct ...``; run it with ``spark-submit`` on a cluster."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.operators import anneal, batches, counts, design, draws, intervals, primers, reads, recover, tags
from tallyseq.plans import summary
from tallyseq.sinks import files as sinks, workbooks
from tallyseq.session import materialize
from tallyseq.sources import bam, files, inputs
from tallyseq.sources.workbooks import read_order


def matrix(spark: SparkSession, a: argparse.Namespace) -> None:
    groups = files.read_groups(spark, files.expand_paths(spark, a.groups))
    sinks.write_matrix(counts.complete((counts.raw_counts if a.raw else counts.molecule_counts)(groups), groups), a.out)


def read_stats(spark: SparkSession, a: argparse.Namespace) -> None:
    first, second = (files.expand_paths(spark, p) for p in (a.first, a.second))
    pairs = files.read_pairs(spark, first, second).withColumn("comment", F.col("comment1"))
    reads.read_stats(pairs).write.partitionBy("sample").mode("overwrite" if a.overwrite else "ignore").parquet(a.out, compression="zstd")


def summarize(spark: SparkSession, a: argparse.Namespace) -> None:
    read = lambda paths, how: how(files.expand_paths(spark, paths)) if paths else None
    table = summary.run_summary(
        read(a.raw, lambda p: files.read_first_mate_counts(spark, p, "raw")),
        read(a.trimmed, lambda p: files.read_first_mate_counts(spark, p, "pass_qc")),
        read(a.aligner, lambda p: files.read_aligner_logs(spark, p)),
        read(a.tagger, lambda p: files.read_tagger_logs(spark, p)),
        files.read_matrix(spark, a.matrix) if a.matrix else None,
    )
    summary.assert_order(table, summary.RUN_EDGES).orderBy("sample").write.csv(a.out, sep="\t", header=True)


def assign(spark: SparkSession, a: argparse.Namespace) -> None:
    """Genes of aligned reads by their start and the length of their bases."""
    rows = bam.read_alignments(spark, files.expand_paths(spark, a.alignments)).where("contig <> '*'")
    spans = rows.select(F.col("qname").alias("read_id"), "contig", F.col("pos").alias("start"), (F.col("pos") + F.length("seq") - 1).alias("end"))
    exons = files.read_gtf(spark, files.expand_paths(spark, a.annotation)).where("feature = 'exon'")
    intervals.assign_genes(spans, exons.select(F.col("gene_id").alias("gene"), F.col("seqname").alias("contig"), (F.col("start") - 1).alias("start"), (F.col("end") - 1).alias("end"))).write.csv(a.out, sep="\t", header=True)


def panel(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = spark.read.csv(files.expand_paths(spark, a.candidates), sep="\t", header=True).select(F.col("geneSymbol").alias("gene"), "amplicon_index", F.col("L_seq").alias("l_seq"), F.col("R_seq").alias("r_seq"))
    anneal.anneal(rows, a.steps, a.chains, seed=a.seed).write.csv(a.out, sep="\t", header=True)


def subset(spark: SparkSession, a: argparse.Namespace) -> None:
    """Primer rows of the target genes."""
    table = lambda path: spark.read.csv(path, sep="\t", header=True)
    plain = lambda df, names: df.withColumnsRenamed(names)
    ids = {"geneSymbol": "gene_symbol", "transcriptID": "transcript_id", "geneID": "gene_id", "L_seq": "l_seq", "R_seq": "r_seq"}
    tables = [plain(table(p), ids) for p in (a.transcripts, a.primer_seqs, a.primer_info)]
    _, _, info = design.catalog_subset(inputs.read_gene_table(spark, a.genes), *tables)
    info.select(*tables[2].columns).write.csv(a.out, sep="\t", header=True)


def product(spark: SparkSession, a: argparse.Namespace) -> None:
    """Amplicons of selected pairs as sequences; pairs without one are told by reason."""
    selected = inputs.selected_pairs(spark.read.csv(a.selected, sep="\t", header=True))
    found = materialize(design.amplicon_regions(selected, inputs.read_primer_info(spark, a.info), inputs.read_reference(spark, files.expand_paths(spark, a.reference))))
    sinks.write_regions(found, a.out)
    for r in found.groupBy("status").count().orderBy("status").collect():
        print(r["status"], r["count"])


def _sheet(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    selected = inputs.selected_pairs(spark.read.csv(a.selected, sep="\t", header=True)).select("primer_index")
    info = inputs.renamed(spark.read.csv(a.info, sep="\t", header=True), {"amplicon_index": "amplicon_index", "geneSymbol": "gene_symbol", "geneID": "gene_id", "L_seq": "l_seq", "R_seq": "r_seq", "pool": "pool"})
    return design.order_sheet(selected, info, inputs.read_gene_table(spark, a.genes), a.linkers)


def _write_table(rows: DataFrame, path: str, *keys: str) -> None:
    """A workbook if the path ends in .xlsx, else a folder of text."""
    if path.endswith(".xlsx"):
        workbooks.write_workbook(rows, path, *[F.col(c).asc_nulls_last() for c in keys])
    else:
        rows.orderBy(*[F.col(c).asc_nulls_last() for c in keys]).write.csv(path, sep="\t", header=True)


def order(spark: SparkSession, a: argparse.Namespace) -> None:
    _write_table(_sheet(spark, a), a.out, *design.SHEET_ORDER)


def pools(spark: SparkSession, a: argparse.Namespace) -> None:
    _write_table(design.ordered_primers(_sheet(spark, a).where("amplicon_index is not null"), a.prefix), a.out, "position")


def recover_pool(spark: SparkSession, a: argparse.Namespace) -> None:
    """From an ordered pool (pool, sequence), a workbook or text, and transcripts to the pairs behind it, as rows of an order; checks beside them."""
    paths = files.expand_paths(spark, a.ordered)
    ordered = read_order(spark, paths).select("pool", "sequence") if paths[0].endswith(".xlsx") else spark.read.csv(paths, sep="\t", header=True)
    pool = materialize(recover.classify(ordered.toDF("pool", "sequence"), a.linkers))
    transcripts = inputs.read_reference(spark, files.expand_paths(spark, a.reference))
    kinds = pool.groupBy(F.upper("primer_seq").alias("pattern")).agg(F.min("primer_type").alias("primer_type"))
    located = materialize(primers.locate(transcripts, kinds.select("pattern")).join(kinds, "pattern"))
    found = recover.mark_passing(primers.amplicons(located), a.low, a.high).where("pass")
    named = materialize(recover.named_amplicons(found, pool))
    design.recovered_orders(recover.list_pairs(named), linkers=a.linkers).orderBy("gene_id", "amplicon_index").write.csv(a.out, sep="\t", header=True)
    places = located.withColumn("gene_id", recover.split_seq_id(F.col("seq_id"))["gene_id"])
    pairs = named.select(F.col("primer_seq_fwd").alias("fwd"), F.col("primer_seq_rev").alias("rev"), "gene_id", "pool_fwd", "pool_rev")
    recover.sanity_report(pool, places, pairs).write.csv(f"{a.out}_checks", sep="\t", header=True)


def rarefy(spark: SparkSession, a: argparse.Namespace) -> None:
    """Draws of a count matrix to a depth per sample, and the metadata of the draws."""
    rows = files.read_matrix(spark, a.matrix)
    metadata = spark.read.csv(a.metadata, sep="\t", header=True) if a.metadata else rows.select("sample").distinct()
    plan = materialize(counts.rarefaction_plan(rows, metadata, a.repeats, a.depth or None, a.key))
    drawn = draws.draw_samples(rows, plan, a.seed)
    sinks.write_matrix(counts.complete(drawn, plan.select("sample")), a.out)
    plan.orderBy("sample").write.csv(f"{a.out}_metadata", sep="\t", header=True)


def correct(spark: SparkSession, a: argparse.Namespace) -> None:
    """Batch-corrected counts of a matrix; ``samples`` has sample, batch and, if known, group."""
    known = spark.read.csv(a.samples, sep="\t", header=True)
    known = known if "group" in known.columns else known.withColumn("group", F.lit(""))
    sinks.write_matrix(batches.correct_batches(files.read_matrix(spark, a.matrix), known.select("sample", "batch", "group"), keep_zero=a.keep_zero), a.out)


def record_tags(spark: SparkSession, a: argparse.Namespace) -> None:
    """Alignment records with their tags: whole records as a folder of files if ``out`` ends in .bam or .sam, else a table of the tags."""
    paths = files.expand_paths(spark, a.alignments)
    rows = bam.read_alignments(spark, paths)
    cell = None if a.cell == "-" else a.cell
    if a.out.endswith(".bam"):
        bam.write_bam(tags.tagged_records(rows, cell), a.out, bam.alignment_header(spark, paths))
    elif a.out.endswith(".sam"):
        sinks.write_sam(tags.tagged_records(rows, cell), a.out, bam.alignment_header(spark, paths))
    else:
        named = rows.select(F.lit(a.cell).alias("sample"), "ord", "qname", "flag", F.col("tags")["XT"].alias("xt"))
        tags.record_tags(named).drop("sample").write.csv(a.out, sep="\t", header=True)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyseq", description=__doc__)
    sub = top.add_subparsers(required=True)

    def command(name, run, *needed: str, **optional):
        p = sub.add_parser(name)
        for n in (*needed, "out"):
            p.add_argument(n)
        for n, default in optional.items():
            p.add_argument(f"--{n}", **({"action": "store_true"} if default is False else {"default": default, "type": type(default) if default is not None else str}))
        p.set_defaults(run=run)

    command("matrix", matrix, "groups", raw=False)
    command("read-stats", read_stats, "first", "second", overwrite=False)
    command("summary", summarize, raw=None, trimmed=None, aligner=None, tagger=None, matrix=None)
    command("assign", assign, "alignments", "annotation")
    command("subset", subset, "genes", "transcripts", "primer_seqs", "primer_info")
    command("product", product, "selected", "info", "reference")
    command("order", order, "selected", "info", "genes", linkers=False)
    command("pools", pools, "selected", "info", "genes", linkers=False, prefix="pool")
    command("tags", record_tags, "alignments", cell="-")
    command("recover", recover_pool, "ordered", "reference", linkers=False, low=-1, high=-1)
    command("rarefy", rarefy, "matrix", metadata=None, repeats=20, depth=0, key=None, seed=42)
    command("correct", correct, "matrix", "samples", keep_zero=False)
    command("panel", panel, "candidates", steps=1000, chains=8, seed=42)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("tallyseq").getOrCreate(), args)


if __name__ == "__main__":
    main()
