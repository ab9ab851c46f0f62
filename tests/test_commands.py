"""Summaries and commands on small files."""

import math

import pytest
from pyspark.errors import PySparkException

from tallyseq.__main__ import main
from tallyseq.operators import counts, stats
from tallyseq.plans import summary
from tallyseq.sources import files


STEPS = ("raw", "pass_qc", "long_read", "not_na_adapter", "good_umi", "mapped", "assigned", "counted", "counted_assigned")


def counts_of(k):
    """Reads left after each step of sample ``k``: every step keeps a share that falls with the step."""
    n = dict(zip(STEPS, (7000 + 313 * k - (41 + 7 * k) * i * i for i in range(len(STEPS))), strict=True))
    return n | {"mapped": n["good_umi"] - k, "cells": {"geneA": 11 + k, "geneB": 5 * (k % 2)}}


@pytest.fixture
def sources(tmp_path):
    samples = {f"lib{k}": counts_of(k) for k in range(3)}
    table = lambda key, name: "file\tnum_seqs\n" + "".join(f"{name.format(s, mate)}\t{n[key]}\n" for s, n in samples.items() for mate in (1, 2))
    (tmp_path / "raw.tsv").write_text(table("raw", "{}_L1_R{}_001.fastq.gz"))
    (tmp_path / "trimmed.tsv").write_text(table("pass_qc", "{}_{}.fq.gz"))
    lines = []
    for name, n in samples.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "Log.final.out").write_text(f"  Number of input reads |\t{n['long_read']}\n")
        lines.append(f"SUMMARY cell_tag={name} total_r1={n['long_read']} " + " ".join(f"{key}={n[key]}" for key in STEPS[3:]))
    (tmp_path / "tagger.log").write_text("\n".join(lines) + "\n")
    (tmp_path / "m.tsv").write_text("sample\tgeneA\tgeneB\n" + "".join(f"{s}\t{n['cells']['geneA']}\t{n['cells']['geneB']}\n" for s, n in samples.items()))
    return tmp_path


def test_summary_command(spark, sources):
    main(["summary", "--raw", f"{sources}/raw.tsv", "--trimmed", f"{sources}/trimmed.tsv", "--aligner", f"{sources}/*/Log.final.out", "--tagger", f"{sources}/tagger.log", "--matrix", f"{sources}/m.tsv", f"{sources}/out"])
    got = {r[0]: [int(x) for x in r[1:]] for r in spark.read.csv(f"{sources}/out", sep="\t", header=True).collect()}
    want = {}
    for k in range(3):
        n = counts_of(k)
        want[f"lib{k}"] = [*(n[key] for key in STEPS), sum(n["cells"].values()), sum(v > 0 for v in n["cells"].values())]
    assert got == want


def test_panel_commands(spark, tmp_path):
    put = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    read = lambda name: [r.asDict() for r in spark.read.csv(str(tmp_path / name), sep="\t", header=True).collect()]
    genes = put("genes.tsv", "gene\tgroup\nUno\tg1\nDue\tg2\n")
    transcripts = put("tx.tsv", "geneSymbol\ttranscriptID\tgeneID\nUno\tT1\tE1\nTre\tT3\tE3\n")
    seqs = put("seqs.tsv", "transcriptID\ttranscript_index\nT1\tT1_0\nT3\tT3_0\n")
    info = put("info.tsv", "transcript_index\tgeneID\tL_seq\nT1_0\tE1\tAC\nT3_0\tE3\tGT\n")
    main(["subset", genes, transcripts, seqs, info, f"{tmp_path}/subset"])
    assert read("subset") == [{"transcript_index": "T1_0", "gene_id": "E1", "l_seq": "AC"}]
    full = put("full.tsv", "amplicon_index\tgeneID\tgeneSymbol\ttranscriptID\tL_seq\tL_start\tR_seq\tR_start\tamplicon_size\tpool\nT1_0\tE1\tUno\tT1\tAC\t2\tGG\t5\t4\tpoolX\n")
    selected = put("selected.tsv", "transcriptID\tprimerIndex\tsequenceLeft\tsequenceRight\nT1\tT1_0\tAC\tGG\nT9\tT9_0\tAC\tGG\n")
    fasta = put("ref.fa", ">T1 x\nTACGTT\n")
    main(["product", selected, full, fasta, f"{tmp_path}/regions"])
    assert [(r.seq_id, r.seq) for r in files.read_fasta(spark, [f"{tmp_path}/regions"]).collect()] == [("T1_0", "ACGT")]
    main(["order", selected, full, genes, f"{tmp_path}/order", "--linkers"])
    (row,) = [r for r in read("order") if r["amplicon_index"]]
    assert (row["group"], row["chosen_index"], row["order_forward"][-9:]) == ("g1", "0", "NACATCAAC")
    main(["pools", selected, full, genes, f"{tmp_path}/pools", "--prefix", "mine"])
    assert [(r["pool_name"], r["direction"]) for r in sorted(read("pools"), key=lambda r: r["position"])] == [("mine", "forward"), ("mine", "reverse")]


def test_summary_with_absent_sources_and_broken_order(spark, sources):
    raw = spark.createDataFrame([("s1", 100)], "sample string, raw long")
    trimmed = spark.createDataFrame([("s1", 200)], "sample string, pass_qc long")
    one = summary.run_summary(raw).first()
    assert one["raw"] == 100 and one["mapped"] is None
    with pytest.raises(PySparkException, match="raw<pass_qc"):
        summary.assert_order(summary.run_summary(raw, trimmed), summary.RUN_EDGES).collect()
    with pytest.raises(ValueError):
        summary.run_summary()


def test_strict_differences(spark):
    table = spark.createDataFrame([("s1", 5, 1), ("s2", 1, 1)], "sample string, counted long, counted_assigned long")
    groups = spark.createDataFrame([("s1", "Unassigned,F+R"), ("s1", "G,F+R"), ("s2", "G,F+R")], "sample string, gene string")
    matrix = spark.createDataFrame([("s1", "G", 1), ("s2", "G", 2)], "sample string, feature string, n long")
    found = summary.strict_differences(table, groups, matrix)
    assert sorted(map(tuple, found.collect())) == [("s1", "counted<>rows"), ("s2", "counted_assigned<>matrix_sum")]


def test_matrix_and_assign_commands(spark, tmp_path):
    names = [f.split()[0] for f in files.GROUP_SCHEMA.split(", ")]
    (tmp_path / "s1.tsv").write_text("\t".join(names) + "\nr\tc\t1\tG1,F+R\tA\t1\tA\t1\t0\n")
    (tmp_path / "s2.tsv").write_text("\t".join(names) + "\nr\tc\t1\tUnassigned,F+R\tA\t1\tA\t1\t0\n")
    main(["matrix", f"{tmp_path}/s*.tsv", f"{tmp_path}/m.csv"])
    assert sorted(map(tuple, files.read_matrix(spark, f"{tmp_path}/m.csv").collect())) == [("s1", "G1", 1), ("s2", "G1", 0)]
    (tmp_path / "x.sam").write_text("q\t0\tc\t10\t9\t4M\t*\t0\t0\tACGT\tIIII\nz\t0\tc\t14\t9\t4M\t*\t0\t0\tACGT\tIIII\n")
    (tmp_path / "x.gtf").write_text('c\tx\texon\t13\t13\t.\t+\t.\tgene_id "E1.2";\n')
    main(["assign", f"{tmp_path}/x.sam", f"{tmp_path}/x.gtf", f"{tmp_path}/genes"])
    assert sorted(map(tuple, spark.read.csv(f"{tmp_path}/genes", sep="\t", header=True).collect())) == [("q", "E1"), ("z", "Unassigned")]


def test_size_factors_and_centering(spark):
    cells = [("a", "x", 2), ("a", "y", 8), ("b", "x", 8), ("b", "y", 32), ("b", "z", 5)]
    found = dict(map(tuple, stats.size_factors(spark.createDataFrame(cells, "sample string, feature string, n long")).collect()))
    assert math.isclose(found["a"], 0.5) and math.isclose(found["b"], 2.0)
    values = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 3.0), ("c", "x", 11.0)], "sample string, feature string, value double")
    batches = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2")], "sample string, batch string")
    assert sorted(map(tuple, stats.center_batches(values, batches).collect())) == [("a", "x", 4.0), ("b", "x", 6.0), ("c", "x", 5.0)]


def test_rarefied_repeats(spark):
    cells = [("a", "x", 4), ("a", "y", 3), ("a", "z", 1), ("b", "x", 2), ("b", "y", 1)]
    table = spark.createDataFrame(cells, "sample string, feature string, n long")

    def drawn(**how):
        rows = [tuple(r) for r in counts.rarefy_repeats(table, 3, **how).collect()]
        sums = {}
        for sample, feature, n in rows:
            assert n <= {(s, f): m for s, f, m in cells}[sample.split("_")[0], feature]
            sums[sample] = sums.get(sample, 0) + n
        return sums, sorted(rows)

    assert drawn(depth=4)[0] == {"a_rarefied_0": 4, "a_rarefied_1": 4, "a_rarefied_2": 4, "b_rarefied_0": 3}
    assert drawn()[0] == {f"{s}_rarefied_{i}": 2 for s in "ab" for i in range(3)}
    assert drawn(seed=1)[1] == drawn(seed=1)[1] != drawn(seed=2)[1]
