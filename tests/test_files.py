"""Files: what is written reads back; odd files raise."""

import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyseq.operators import counts, recover
from tallyseq.sinks import files as sinks
from tallyseq.sources import files
from tallyseq.streaming.counting import stream_molecule_counts


def test_fastq_pairs_across_splits(spark, tmp_path):
    n = 3000
    for mate in (1, 2):
        with (tmp_path / f"s1_R{mate}.fastq").open("w") as f:
            f.writelines(f"@r{i} x:{mate}\n{'ACGT' * 5}\n+\n@{'I' * 19}\n" for i in range(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = files.read_pairs(spark, [str(tmp_path / "s1_R1.fastq")], [str(tmp_path / "s1_R2.fastq")])
        assert found.count() == n
        bad = found.where("read_id <> concat('r', ord) or r2_qual <> concat('@', repeat('I', 19)) or comment2 <> 'x:2' or sample <> 's1'")
        assert bad.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fastq_gzip_and_mates_that_differ(spark, tmp_path):
    for mate, name in ((1, "a"), (2, "b")):
        with gzip.open(tmp_path / f"s1_{mate}.fq.gz", "wt") as f:
            f.write(f"@{name}\nAC\n+\nII\n")
    one = files.read_fastq(spark, [str(tmp_path / "s1_1.fq.gz")])
    assert [r["read_id"] for r in one.collect()] == ["a"]
    with pytest.raises(PySparkException, match="mates differ"):
        files.read_pairs(spark, [str(tmp_path / "s1_1.fq.gz")], [str(tmp_path / "s1_2.fq.gz")]).collect()
    sinks.write_fastq(one, str(tmp_path / "out"))
    again = files.read_fastq(spark, [str(tmp_path / "out")]).select("read_id", "comment", "seq", "qual")
    assert [tuple(r) for r in again.collect()] == [("a", "", "AC", "II")]


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a one\nac\ngt\n\n>b\r\nAA\r\n>a two>x\nTT\n")
    found = {r["seq_id"]: (r["description"], r["seq"]) for r in files.read_fasta(spark, [str(tmp_path / "x.fa")]).collect()}
    assert found == {"a": ("a two>x", "TT"), "b": ("b", "AA")}
    sinks.write_fasta(files.read_fasta(spark, [str(tmp_path / "x.fa")]), str(tmp_path / "out"), F.lit("d"))
    assert {(r["seq_id"], r["seq"]) for r in files.read_fasta(spark, [str(tmp_path / "out")]).collect()} == {("a", "TT"), ("b", "AA")}


def test_sam_round_trip(spark, tmp_path):
    line = "q_A_C_F+R\t99\tchr1\t101\t60\t4M\t=\t201\t104\tACGT\tIIII"
    (tmp_path / "x.sam").write_text(f"@HD\tVN:1.6\n{line}\tXT:Z:G1\n{line}\n")
    rows = files.read_sam(spark, [str(tmp_path / "x.sam")])
    assert [(r["pos"], r["flag"], r["tags"]) for r in rows.orderBy("ord").collect()] == [(100, 99, {"XT": "G1"}), (100, 99, {})]
    sinks.write_sam(rows, str(tmp_path / "out"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted([line, f"{line}\tXT:Z:G1"])


def test_logs_groups_and_annotation(spark, tmp_path):
    (tmp_path / "t.log").write_text("x\nSUMMARY cell_tag=s1 total_r1=1 mapped=2\nSUMMARY cell_tag=s1 total_r1=5\n")
    assert [tuple(r) for r in files.read_tagger_logs(spark, [str(tmp_path / "t.log")]).collect()] == [("s1", {"total_r1": 5})]
    (tmp_path / "u.log").write_text("SUMMARY cell_tag=- total_r1=1\n")
    with pytest.raises(PySparkException, match="names no sample"):
        files.read_tagger_logs(spark, [str(tmp_path / "u.log")]).collect()
    (tmp_path / "s9").mkdir()
    (tmp_path / "s9" / "Log.final.out").write_text(" Number of input reads |\t900\n")
    assert [tuple(r) for r in files.read_aligner_logs(spark, [str(tmp_path / "s9" / "Log.final.out")]).collect()] == [("s9", 900)]
    (tmp_path / "stats.tsv").write_text("file\tnum_seqs\ns1_S1_R1_001.fastq.gz\t10\ns1_S1_R2_001.fastq.gz\t10\n")
    assert [tuple(r) for r in files.read_first_mate_counts(spark, [str(tmp_path / "stats.tsv")]).collect()] == [("s1", 10)]
    names = [f.split()[0] for f in files.GROUP_SCHEMA.split(", ")]
    rows = ["read1 chr1 100 Unassigned,FGR+FGR AAAAAATTTTTT 1 AAAAAATTTTTT 1 0", "read2 chr1 200 GENE1,FGR+FGR CCCCCCGGGGGG 1 CCCCCCGGGGGG 1 1"]
    (tmp_path / "s2.group.tsv").write_text("\n".join(["\t".join(names), *[r.replace(" ", "\t") for r in rows]]) + "\n")
    groups = files.read_groups(spark, [str(tmp_path / "s2.group.tsv")])
    found = counts.molecule_counts(groups)
    assert [tuple(r) for r in found.collect()] == [("s2", "GENE1", 1)]
    sinks.write_matrix(found, str(tmp_path / "m.tsv"))
    assert [tuple(r) for r in files.read_matrix(spark, str(tmp_path / "m.tsv")).collect()] == [("s2", "GENE1", 1)]
    with pytest.raises(ValueError):
        sinks.write_matrix(found, str(tmp_path / "m.xls"))
    (tmp_path / "x.gtf").write_text('#c\nchr1\tx\tgene\t1\t9\t.\t+\t.\tgene_id "E1.4"; gene_name "Ab";\n')
    assert [tuple(r) for r in files.gene_symbols(files.read_gtf(spark, [str(tmp_path / "x.gtf")])).collect()] == [("E1", "Ab")]


def test_paths(spark, tmp_path):
    for name in ("s10.tsv", "s2.tsv", "x.txt"):
        (tmp_path / name).write_text("")
    found = files.expand_paths(spark, str(tmp_path), (".tsv",))
    assert [p.rsplit("/", 1)[1] for p in found] == ["s2.tsv", "s10.tsv"]
    with pytest.raises(FileNotFoundError):
        files.expand_paths(spark, f"{tmp_path}/*.bam")
    with pytest.raises(TypeError):
        files.expand_paths(spark, 3)


def test_classify(spark):
    order = spark.createDataFrame([("Pool1", "CCTACACGACGCTCTTCCGATCTNNNNNNACATCAATGAAGACGGCATC"), ("Pool2", "TCAGACGTGTGCTCTTCCGATCTNNNNNNATAGTTATGAAGGCTTCC")], "pool string, sequence string")
    assert [(r["primer_type"], r["primer_seq"]) for r in recover.classify(order).orderBy("pool").collect()] == [("fwd", "ATGAAGACGGCATC"), ("rev", "ATGAAGGCTTCC")]
    with pytest.raises(PySparkException, match="no known prefix"):
        recover.classify(spark.createDataFrame([("P", "ACGT")], "pool string, sequence string")).collect()


def test_streamed_counts_match_batch(spark, tmp_path):
    rows = spark.range(400).selectExpr("concat('s', id % 2) AS sample", "concat('G', id % 5, ',F+R') AS gene", "cast(id % 30 AS string) AS final_umi", "timestamp_seconds(id) AS at")
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    query = stream_molecule_counts(source, "at", "1 hour").writeStream.format("memory").queryName("streamed").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {tuple(r) for r in spark.table("streamed").collect()} == {tuple(r) for r in counts.molecule_counts(rows).collect()}
