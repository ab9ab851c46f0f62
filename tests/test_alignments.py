"""Order of records across files, records of a name together, statuses of odd alignments."""

import glob
import random

import pyarrow.parquet as pq
import pytest

from tallyseq.operators import alignments


def test_order_across_files(spark, tmp_path):
    dice = random.Random(3)
    rows = [(f"q{i}", dice.choice(["c1", "c2", None]), dice.choice([7, 7, 7, dice.randrange(10**6)])) for i in range(4000)] + [("u", None, None)]
    table = spark.createDataFrame(rows, "qname string, contig string, start long").repartition(7)
    alignments.by_place(table, "qname", files=5).write.parquet(str(tmp_path / "sorted"))
    found = [tuple(r.values()) for f in sorted(glob.glob(str(tmp_path / "sorted" / "*.parquet"))) for r in pq.read_table(f).to_pylist()]
    key = lambda r: (r[1] is None, r[1] or "", r[2] is None, r[2] or 0, r[0])
    assert found == sorted(rows, key=key) and len(glob.glob(str(tmp_path / "sorted" / "*.parquet"))) > 1
    index = {(r.contig, r.bin): (r.first, r.records) for r in alignments.place_index(table, "qname").collect()}
    for (contig, bin_), (first, n) in index.items():
        own = [i for i, r in enumerate(found) if r[1] == contig and r[2] >> alignments.INDEX_BITS == bin_]
        assert own == list(range(first, first + n))


def test_names_stay_together(spark, tmp_path):
    rows = [(f"q{i % 50}", i) for i in range(400)]
    alignments.collated(spark.createDataFrame(rows, "qname string, ord int"), "ord").write.parquet(str(tmp_path / "by_name"))
    for f in glob.glob(str(tmp_path / "by_name" / "*.parquet")):
        own = [tuple(r.values()) for r in pq.read_table(f).to_pylist()]
        assert own == sorted(own)
    every = [set(pq.read_table(f)["qname"].to_pylist()) for f in glob.glob(str(tmp_path / "by_name" / "*.parquet"))]
    assert sum(map(len, every)) == 50


def test_statuses(spark):
    rows = spark.createDataFrame(
        [("a", "c", 1, 10, "+", 1), ("b", "c", 1, 10, "+", 4), ("d", "c", 1, 40, "-", 1), ("e", None, None, None, None, None), ("f", "c", 30, 31, None, 1), ("g", "c", 90, 99, "+", 0), ("a", "c", 1, 10, "+", 1)],
        "read_id string, contig string, start long, end long, strand string, hits int",
    )
    exons = spark.createDataFrame([("G1", "c", 5, 20, "+"), ("G2", "c", 8, 35, "-"), ("G1", "c", 9, 12, "+")], "gene string, contig string, start long, end long, strand string")

    def told(*how, **more):
        return sorted((r.read_id, r.status, tuple(r.genes), round(r.weight, 6)) for r in alignments.assign_features(rows, exons, *how, **more).collect())

    none = [("e", "none", (), 0.0), ("f", "none", (), 0.0), ("g", "none", (), 0.0)]
    assert told(1) == sorted([("a", "assigned", ("G1",), 1.0)] * 2 + [("b", "assigned", ("G1",), 1.0), ("d", "assigned", ("G2",), 1.0)] + none)
    assert told(0, fraction=True)[2:4] == [("b", "assigned", ("G1", "G2"), 0.125), ("d", "assigned", ("G1", "G2"), 0.5)]
    strict = told(0, overlap=False, multiple=False)
    assert [s for _, s, _, _ in strict] == ["ambiguous", "ambiguous", "multiple", "ambiguous", "none", "assigned", "none"]
    assert {r.gene: r.n for r in alignments.feature_totals(alignments.assign_features(rows, exons, 2)).collect()} == {"G2": 3.0, "G1": 1.0}
    assert alignments.assign_features(rows.limit(0), exons).count() == 0 and alignments.assign_features(rows, exons.limit(0)).count() == 7
    with pytest.raises(ValueError, match="strand"):
        alignments.assign_features(rows, exons, 3)


def test_places_are_counted_before_they_meet_genes(spark, monkeypatch):
    rows = spark.range(600).selectExpr("cast(id AS string) AS read_id", "'c' AS contig", "id % 5 * 10 AS start", "id % 5 * 10 + 9 AS end", "CASE id % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' END AS strand", "CASE WHEN id % 4 > 0 THEN cast(id % 4 AS int) END AS hits")
    exons = spark.createDataFrame([("A", "c", 0, 5, "+"), ("B", "c", 8, 25, "-"), ("C", "c", 33, 41, "+")], "gene string, contig string, start long, end long, strand string")
    told, met = alignments._told, []
    monkeypatch.setattr(alignments, "_told", lambda numbered, *how: met.append(numbered.count()) or told(numbered, *how))
    for how in ((0, True, True, True), (1, True, True, False), (0, False, False, False), (2, True, False, True)):
        want = {r.gene: r.n for r in alignments.feature_totals(alignments.assign_features(rows, exons, *how)).collect()}
        got = {r.gene: r.n for r in alignments.feature_counts(rows, exons, *how).collect()}
        assert set(got) == set(want) and all(abs(got[g] - want[g]) < 1e-9 for g in want)
        assert met[-2] == 600 and met[-1] <= 45
