"""Primers found in reads that lack a base of them or have one more."""

import pytest
from pyspark.sql import functions as F

from tallyseq.operators import assign
from tallyseq.sources import views


def test_one_insertion_and_one_deletion(spark):
    reads = spark.createDataFrame([("in", "GGGGACGTTACGTACGGGGG"), ("del", "GGGGACGACGTACGGGGG"), ("in2", "CCAACCGGTTGTCCAGTGACTTACC"), ("none", "GGGGGGGG")], "read_id string, seq string")
    panel = spark.createDataFrame([("P", "ACGTACGTAC"), ("Q", "AACCGGTTTCCATGACTTAC")], "adapter string, primer string")
    found = {r.read_id: (r.adapter, r.match, r.start, r.errors) for r in assign.assign_primers(reads, panel, 0.1).collect()}
    assert found["in"] == ("P", "ACGTTACGTAC", 4, 1) and found["del"] == ("P", "ACGACGTAC", 4, 1)
    assert found["in2"][0] == "Q" and found["in2"][3] == 2 and found["none"] == ("no_adapter", "", None, None)


def test_letters_are_compared_as_they_are(spark):
    reads = spark.createDataFrame([("n", "ggacgnacgtacgg"), ("x", "GGACGéACGTACGG"), ("null", None)], "read_id string, seq string")
    panel = spark.createDataFrame([("P", "ACGNACGTAC")], "adapter string, primer string")
    found = {r.read_id: (r.adapter, r.match, r.start, r.errors) for r in assign.assign_primers(reads, panel, 0.1, indels=False).collect()}
    assert found == {"n": ("P", "ACGNACGTAC", 2, 0), "x": ("P", "ACGÉACGTAC", 2, 1), "null": ("no_adapter", "", None, None)}


@pytest.mark.parametrize("indels", [False, True])
def test_reads_of_one_file_are_dealt_and_not_joined(spark, indels):
    pairs = views.read_pairs(spark, "/root/testdata/sf0.001")
    assert pairs.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    panel = spark.createDataFrame([("P", "TTGCTTGG")], "adapter string, primer string")
    found = assign.assign_primers(pairs.select("read_id", F.col("r1_seq").alias("seq")), panel, 0.125, indels)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
