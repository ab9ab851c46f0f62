"""Tails by windows of quality, adapters at any place and cut short at the end, odd reads."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tallyseq.operators import trimming
from tallyseq.sources import views


def test_tails(spark):
    dice = random.Random(2)
    quals = [None, "", "I", "#", "II#", "####", "IIII####", "####IIII"] + ["".join(chr(33 + dice.choice([2, 10, 19, 20, 21, 40])) for _ in range(dice.randint(1, 30))) for _ in range(80)]
    rows = spark.createDataFrame([(i, q) for i, q in enumerate(quals)], "id int, q string")
    for window, mean in ((4, 20), (1, 20.5), (7, 15)):
        got = {r.id: r.n for r in rows.select("id", trimming.tail_length(F.col("q"), window, mean).alias("n")).collect()}
        for i, q in enumerate(quals):
            v = [ord(c) - 33 for c in q or ""]
            w = min(window, len(v))
            assert got[i] == (max((p for p in range(w, len(v) + 1) if sum(v[p - w : p]) >= mean * w), default=0) if v else 0)
    with pytest.raises(ValueError, match="window"):
        trimming.tail_length(F.col("q"), 0)


def test_adapters(spark):
    adapter = "AGATCGGAAGAGC"
    good = "I" * 60
    reads = ["ACGTTT" + adapter + "GGGG", "ACGTTT" + adapter[:6], "ACGTTT" + adapter[:4], "ACGTTTAGATCGCAAGAGCTT", adapter, "CCCCCC", None, "ACGTTTagatcggaagagc", "NNNNNNNN"]
    rows = [(i, r, good[: len(r or "")] if r else None, "ACGTACGT", "IIIIIIII") for i, r in enumerate(reads)]
    pairs = spark.createDataFrame(rows, "read_id int, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    got = {r.read_id: r for r in trimming.trim_pairs(pairs, [adapter], []).collect()}
    assert [got[i].r1_seq for i in range(9)] == ["ACGTTT", "ACGTTT", "ACGTTTAGAT", "ACGTTT", "", "CCCCCC", None, "ACGTTT", "NNNNNNNN"]
    assert all(len(r.r1_qual or "") == len(r.r1_seq or "") and r.r2_seq == "ACGTACGT" for r in got.values())
    assert trimming.trim_pairs(pairs.limit(0), [adapter], [adapter]).count() == 0


def test_pairs_of_one_file_are_dealt(spark):
    pairs = views.quality_pairs(spark, "/root/testdata/sf0.001")
    assert pairs.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def test_a_tail_takes_time_that_grows_with_the_read():
    times = []
    for n in (20_000, 320_000):
        began = time.perf_counter()
        assert trimming.tail_sizes(["I" * n + "#" * n] * 3, 4, 20).tolist() == [n + 2] * 3
        times.append(time.perf_counter() - began)
    assert times[1] < 100 * times[0] + 0.1
