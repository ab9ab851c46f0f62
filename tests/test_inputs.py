"""Smaller inputs, order sheets and panels on small cases."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyseq.operators import counts, design, quality
from tallyseq.sinks import files as sinks
from tallyseq.sources import files, inputs


def test_paths(spark):
    mates = {"a_R1.fq.gz": "a_R2.fq.gz", "b_1.fastq": "b_2.fastq", "c.R1.fq": "c.R2.fq", "d.1.fastq": "d.2.fastq", "e_R1_001.fq": "e_R2_001.fq", "f_r1.fq": "f_r2.fq", "g.fq": "g_R2.fq"}
    assert {a: inputs.second_mate(a) for a in mates} == mates
    inputs.check_formats(["x.fq", "y.fastq.gz"], "fastq")
    inputs.check_formats(["x.bam", "y.fq"], "both")
    for paths, kind in ((["x.sam.gz"], "alignment"), (["x.bam"], "fastq"), ([], "other")):
        with pytest.raises(ValueError):
            inputs.check_formats(paths, kind)
    names = spark.createDataFrame([("d/s1.group.tsv.gz", "s1"), ("s2.x.tsv", "s2.x"), ("s3.txt", "s3"), ("s4", "s4")], "path string, want string")
    assert names.where(inputs.sample_of_groups(F.col("path")) != F.col("want")).count() == 0
    assert inputs.reference_path("/r", None, "mouse") == "/r/mouse/transcripts.fa.gz" and inputs.reference_path("/r", "x.fa", "mouse") == "x.fa"
    with pytest.raises(ValueError):
        inputs.reference_path("/r", None, None)


def test_interleaved(spark, tmp_path):
    pair = "@{0} a\nACGT\n+\nIIII\n@{0} b\nTTTT\n+\nFFFF\n"
    (tmp_path / "i.fq").write_text(pair.format("r1") + pair.format("r2") + "\n" * 8 + pair.format("r3"))
    found = inputs.read_interleaved(spark, [str(tmp_path / "i.fq")]).orderBy("ord").collect()
    assert [(r.read_id, r.comment1, r.r1_seq, r.r2_qual) for r in found] == [("r1", "a", "ACGT", "FFFF"), ("r2", "a", "ACGT", "FFFF")]
    (tmp_path / "j.fq").write_text(pair.format("r1").replace("@r1 b", "@r9 b"))
    with pytest.raises(PySparkException, match="mates differ"):
        inputs.read_interleaved(spark, [str(tmp_path / "j.fq")]).collect()


def test_tables(spark, tmp_path):
    put = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    assert [tuple(r) for r in inputs.read_two_columns(spark, put("two.tsv", "gene\tn\nA\t3\n")).collect()] == [("A", 3)]
    with pytest.raises(ValueError, match="two columns"):
        inputs.read_two_columns(spark, put("three.tsv", "gene\tn\tm\nA\t3\t4\n"))
    with pytest.raises(ValueError, match="no column gene"):
        inputs.read_gene_table(spark, put("genes.tsv", "symbol\nA\n"))
    with pytest.raises(ValueError, match="missing columns"):
        inputs.read_primer_info(spark, put("info.tsv", "geneID\nA\n"))
    by_place = inputs.selected_pairs(spark.createDataFrame([("t", "i", "AC", "GT", 1)], "a string, b string, c string, d string, e int"))
    assert by_place.first().asDict() == {"transcript_id": "t", "primer_index": "i", "l_seq": "AC", "r_seq": "GT"}
    with pytest.raises(ValueError):
        inputs.selected_pairs(by_place.select("l_seq"))
    assert {r.name for r in inputs.read_primer_names(spark, put("p.fa", ">F1 x\nAC\n>F2\nGT\n")).collect()} == {"F1", "F2"}
    assert [r.name for r in inputs.read_primer_names(spark, put("p.csv", "id,x\nF3,1\n")).collect()] == ["F3"]
    with pytest.raises(ValueError):
        inputs.read_primer_names(spark, "p.xlsx")
    with pytest.raises(ValueError, match="no sequences"):
        inputs.read_reference(spark, [put("empty.fa", "\n")])


def test_reports_and_aligner_tables(spark, tmp_path):
    folder = tmp_path / "s7_x_R1_001_fastqc"
    folder.mkdir()
    (folder / "fastqc_data.txt").write_text(">>Basic\tpass\n>>END_MODULE\n>>Per sequence quality scores\tpass\n#Quality\tCount\n20\t1.0\n30\t2.0\n37\t1.0\n>>END_MODULE\n")
    found = inputs.read_quality_reports(spark, [str(folder / "fastqc_data.txt")])
    assert [tuple(r) for r in quality.good_ratio(found).collect()] == [("s7", "r1", 0.75)]
    with pytest.raises(PySparkException, match="no section"):
        spark.createDataFrame([("x",)], "v string").select(quality.quality_histogram(F.col("v"))).collect()
    star = tmp_path / "s7"
    star.mkdir()
    (star / "ReadsPerGene.out.tab").write_text("N_unmapped\t5\t5\t5\nN_noFeature\t2\t2\t2\nG1\t3\t1\t2\n")
    rows = inputs.read_gene_reads(spark, [str(star / "ReadsPerGene.out.tab")])
    assert [tuple(r) for r in quality.mapped_reads(rows).collect()] == [("s7", 5)]
    log = star / "Log.final.out"
    log.write_text("Number of input reads |\t70\nx\nNumber of input reads |\t9\n")
    assert [tuple(r) for r in files.read_aligner_logs(spark, [str(log)]).collect()] == [("s7", 70)]


@pytest.mark.parametrize(("genes", "pools"), [(192, {"p": 384}), (200, {"p-p1": 384, "p-p2": 16})])
def test_pools_of_384(spark, genes, pools):
    sheet = spark.range(genes).selectExpr("'pool1' AS pool", "'g' AS group", "concat('G', lpad(id, 4, '0')) AS gene_symbol", "0 AS chosen_index", "concat('A', id) AS amplicon_index", "'AC' AS order_forward", "'GT' AS order_reverse")
    rows = design.ordered_primers(sheet, "p")
    assert {r.pool_name: r["count"] for r in rows.groupBy("pool_name").count().collect()} == pools
    assert rows.groupBy("gene").agg(F.count_distinct("pool_name").alias("n")).where("n > 1").count() == 0


def test_genes_and_primers_that_raise(spark):
    info = spark.createDataFrame([("a_0", "G1", "E1", "AC", "GT", "p")], "amplicon_index string, gene_symbol string, gene_id string, l_seq string, r_seq string, pool string")
    genes = spark.createDataFrame([("G1",), ("G1",)], "gene string")
    with pytest.raises(PySparkException, match="stands twice"):
        design.order_sheet(info.select(F.col("amplicon_index").alias("primer_index")), info, genes).collect()
    assert design.order_sheet(info.select(F.col("amplicon_index").alias("primer_index")), info, genes.distinct()).first().group == "default"
    places = spark.createDataFrame([("AC",), ("TT",)], "primer_seq string")
    pool = spark.createDataFrame([("AC", "fwd", "p"), ("AC", "rev", "q")], "primer_seq string, primer_type string, pool string")
    assert design.located_primers(places.where("primer_seq = 'AC'"), pool).count() == 2
    with pytest.raises(PySparkException, match="not in the pool"):
        design.located_primers(places, pool).collect()
    with pytest.raises(ValueError):
        design.complement_words("a", "b", 5, 4)
    reads = spark.createDataFrame([("s", "r"), ("s", "r")], "sample string, read_id string")
    with pytest.raises(ValueError, match="stands 2 times"):
        quality.assert_unique_reads(reads)
    quality.assert_unique_reads(reads.distinct())


def test_rarefaction_plan_raises(spark):
    rows = spark.createDataFrame([("a", "f", 5), ("b", "f", 3)], "sample string, feature string, n long")
    meta = spark.createDataFrame([("a", "b"), ("b", None)], "sample string, of string")
    got = counts.rarefaction_plan(rows, meta, 3, key="of").orderBy("sample").collect()
    assert [(r.sample, r.target) for r in got] == [("a_rarefied_0", 3), ("a_rarefied_1", 3), ("a_rarefied_2", 3), ("b_rarefied_0", 2), ("b_rarefied_1", 2), ("b_rarefied_2", 2)]
    with pytest.raises(PySparkException, match="no such sample"):
        counts.rarefaction_plan(rows, meta.withColumn("of", F.lit("zz")), 3, key="of").collect()


def test_written_regions(spark, tmp_path):
    rows = spark.createDataFrame([("t1", "t1_0", "ok", "gene:G transcript:t1", "ACGT"), ("t2", "t2_0", "no_transcript", None, None)], "transcript_id string, primer_index string, status string, description string, region string")
    sinks.write_regions(rows, str(tmp_path / "out"))
    got = files.read_fasta(spark, [str(tmp_path / "out")]).collect()
    assert [(r.seq_id, r.description, r.seq) for r in got] == [("t1_0", "t1_0 gene:G transcript:t1", "ACGT")]
