"""Gene names, overlaps and annealing on small cases."""

import itertools

import pytest
from pyspark.sql import functions as F

from tallyseq.functions.gene_names import audit, simplify
from tallyseq import session
from tallyseq.operators import anneal, assign, counts, intervals, primers, recover, stats, tags

NAMES = [
    ("KLRC4-KLRK1,KLRK1", "KLRK1"),
    ("IFNAR2-IL10RB", "IFNAR2-IL10RB"),
    ("ENSG00000173366,Gm3839", "ENSG00000173366,Gm3839"),
    ("Ppp1r1b,1700003D09Rik", "Ppp1r1b"),
    ("Gm10358,Gapdh,Gm3839", "Gapdh"),
    ("MMP24,MMP24OS", "MMP24"),
    ("FOXP3-AS1,FOXP3", "FOXP3"),
    ("MT-CO3,ENSG0000", "MT-CO3,ENSG0000"),
    ("DEFA10P,DEFA1", "DEFA1"),
    ("CLCA3P,CLCA3", "CLCA3"),
    ("RNA18SP5,RNA18S", "RNA18S"),
    ("FOXP3-AS1,GAPDH", "FOXP3-AS1,GAPDH"),
    ("Selenbp1,Sele", "Sele"),
    (" A , ,A", "A"),
    ("", ""),
]


def test_simplified_names(spark):
    rows = spark.createDataFrame(NAMES, "names string, want string")
    found = rows.withColumn("have", F.array_join(simplify(F.split("names", ",")), ",")).where("not have <=> want")
    assert found.collect() == []


def test_audit_tells_each_dropped_name(spark):
    rows = spark.createDataFrame(NAMES, "names string, want string").withColumn("list", F.split("names", ","))
    found = rows.select(simplify(F.col("list")).alias("kept"), audit(F.col("list")).alias("gone"), F.array_distinct(F.filter(F.transform("list", lambda t: F.trim(t)), lambda t: t != "")).alias("every")).collect()
    for r in found:
        assert sorted([*r.kept, *(d.name for d in r.gone)]) == sorted(r.every) and all(d.reason for d in r.gone)
    case = lambda names: spark.createDataFrame([(names,)], "l array<string>").select(audit(F.col("l")).alias("d")).first().d
    assert [tuple(d) for d in case(["Abcd", "Gm12", "Klk1b1", "Klk1"])] == [("Gm12", "dropped: pseudo_like_with_real_symbols_present"), ("Klk1b1", "dropped: pseudo_like_with_real_symbols_present")]
    assert [tuple(d) for d in case(["Sele", "Selenbp1"])] == [("Selenbp1", "collapsed_into_base: base=Sele")]
    assert [tuple(d) for d in case(["KLRC4-KLRK1", "KLRK1"])] == [("KLRC4-KLRK1", "dropped: readthrough_component_present")]


@pytest.mark.parametrize("bits", [0, 3, 10])
def test_overlaps_match_all_pairs(spark, monkeypatch, bits):
    monkeypatch.setattr(intervals, "LEAST_BITS", bits)
    left = [(i, "c", i * 3 % 50, i * 3 % 50 + i % 9) for i in range(40)]
    right = [(100 + i, "c", i * 7 % 50, i * 7 % 50 + i % 13) for i in range(40)]
    have = intervals.overlaps(spark.createDataFrame(left, "a long, contig string, start long, end long"), spark.createDataFrame(right, "b long, contig string, start long, end long"))
    want = sorted((x[0], y[0]) for x, y in itertools.product(left, right) if x[2] <= y[3] and y[2] <= x[3])
    assert sorted((r["a"], r["b"]) for r in have.collect()) == want


def test_exons_of_a_gene_are_merged_before_reads_meet_them(spark):
    exons = spark.createDataFrame([("G1", "c", i, i + 9) for i in range(0, 300, 3)] + [("G1", "c", 400, 410), ("G2", "c", 305, 306), (None, "c", 1, 2), ("G3", "c", 9, 5)], "gene string, contig string, start long, end long")
    assert sorted(map(tuple, intervals.merged(exons.where("gene is not null"), "gene", "contig").collect())) == [("G1", "c", 0, 306), ("G1", "c", 400, 410), ("G2", "c", 305, 306)]
    reads = spark.createDataFrame([("a", "c", 306, 399), ("a", "c", 410, 500), ("b", "c", 307, 399), ("n", None, 1, 2), ("d", "d", 1, 2)], "read_id string, contig string, start long, end long")
    assert sorted(map(tuple, intervals.assign_genes(reads, exons).collect())) == [("a", "G1,G2"), ("b", "Unassigned"), ("d", "Unassigned"), ("n", "Unassigned")]


def test_annealing_finds_the_harmless_design(spark):
    rows = [("g1", 1, "ACGTACGTACGT", "GGGGCCCCGGGG"), ("g1", 2, "AAAAAACAAAAA", "AAACAAAAAACA"), ("g2", 3, "AACAACAACAAC", "CAAAACAAAACA"), (None, 4, "A", "A")]
    candidates = spark.createDataFrame(rows, "gene string, amplicon_index long, l_seq string, r_seq string")
    found = {r["gene"]: r for r in anneal.anneal(candidates, 10, chains=2).collect()}
    assert {g: r["design"] for g, r in found.items()} == {"g1": 2, "g2": 3}
    pool = candidates.where("amplicon_index in (2, 3)").selectExpr("stack(2, concat(gene, 'l'), l_seq, concat(gene, 'r'), r_seq) AS (id, seq)")
    loss = primers.dimer_loss(pool, 4, 8, 3).agg(F.coalesce(F.sum("loss"), F.lit(0.0))).first()[0]
    assert found["g1"]["loss"] == pytest.approx(loss)


def test_a_chain_makes_only_the_tails_that_it_looks_at(spark):
    bases = "translate(md5(cast({} as string)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
    rows = spark.range(210_000).selectExpr("concat('g', id % 3) AS gene", "id AS amplicon_index", f"substring({bases.format('id')}, 1, 14) AS l_seq", f"substring({bases.format('id')}, 15, 14) AS r_seq")
    found = {r["gene"]: r["design"] for r in anneal.anneal(rows, 10, chains=1).collect()}
    assert {g: d % 3 for g, d in found.items()} == {"g0": 0, "g1": 1, "g2": 2}
    asked = set()
    tails_of = lambda at: asked.add(at) or anneal.design_tails("ACGTACGTACGTAC", None, 4, 12, 2)
    losses, best = anneal.run_chain([range(0, 100_000), range(100_000, 100_001)], tails_of, 20, 1)
    assert len(losses) == 31 and len(asked) <= 32 and best[1] == 100_000


def test_sanity_report_and_record_ids(spark):
    pool = spark.createDataFrame([("A", "fwd", "1"), ("A", "rev", "1"), ("C", "rev", "2")], "primer_seq string, primer_type string, pool string")
    located = spark.createDataFrame([("A", "t1", "g1", 1, 1), ("A", "t1", "g1", 5, 5), ("A", "t2", "g2", 1, 2)], "pattern string, seq_id string, gene_id string, start long, end long")
    amplicons = spark.createDataFrame([("A", "C", "g1", "1", "2"), ("A", "C", "g2", "1", "2"), ("A", "T", "g1", "1", "1")], "fwd string, rev string, gene_id string, pool_fwd string, pool_rev string")
    assert [r["n"] for r in recover.sanity_report(pool, located, amplicons).collect()] == [1, 0, 1, 1, 1, 1, 1, 1, 1, 1]
    ids = recover.distinct_record_ids(spark.createDataFrame([("x", "C"), ("x", "A"), ("y", "A")], "record_id string, seq string"))
    assert sorted(map(tuple, ids.collect())) == [("x", "A"), ("x.1", "C"), ("y", "A")]


def test_primers_with_one_error_and_none(spark):
    reads = spark.createDataFrame([("a", "GGACGTACGAACGTAAGG"), ("b", "T"), ("c", "")], "read_id string, seq string")
    panel = spark.createDataFrame([("P", "ACGTACGTACGT"), ("Q", "")], "adapter string, primer string")
    found = {r["read_id"]: (r["adapter"], r["start"], r["errors"]) for r in assign.assign_primers(reads, panel, 0.1).collect()}
    assert found == {"a": ("P", 2, 1), "b": ("no_adapter", None, None), "c": ("no_adapter", None, None)}


def test_fdr_keeps_null_families(spark):
    rows = spark.createDataFrame([(1, "a", 0.01), (2, None, 0.02), (3, None, 0.04), (4, "", 0.5)], "id int, family string, p double")
    got = {r.id: (r.family, round(r.q, 12)) for r in stats.adjust_fdr(rows, "family").collect()}
    assert got == {1: ("a", 0.01), 2: (None, 0.04), 3: (None, 0.04), 4: ("", 0.5)}
    numbers = spark.createDataFrame([(1, None, 0.5), (2, 0, 0.25), (3, 0, 0.5)], "id int, family int, p double")
    assert {r.id: r.q for r in stats.adjust_fdr(numbers, "family").collect()} == {1: 0.5, 2: 0.5, 3: 0.5}


def test_repeated_primaries_are_told_apart(spark):
    name = "q1_ACGTAC_ACGTAC_F1+R1"
    rows = spark.createDataFrame([("s", 1, name, 99, "G2"), ("s", 2, name, 99, None), ("s", 3, name, 147, "G1"), ("s", 4, name, 355, "Unassigned")], "sample string, ord int, qname string, flag int, xt string")
    got = {r.ord: (r.flag, r.us, r.xt, r.xf) for r in tags.record_tags(rows).collect()}
    assert got == {1: (99, "ACGTAC", "G2", "G1,G2,F1+R1"), 2: (355, "ACGTAC", "Unassigned", None), 3: (147, None, "G1", None), 4: (355, None, "Unassigned", None)}


def test_reads_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    rows = spark.range(500).selectExpr("concat('s', id % 400 % 2) AS sample", "concat('q', id % 400) AS read_id", "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN ' B,A,' ELSE concat('C,', id % 2) END AS gene")
    reads = counts.consolidate_reads(rows)
    assert reads.rdd.getNumPartitions() == 50
    want = {}
    for i in range(500):
        want.setdefault(f"q{i % 400}", set()).update(((), ("A", "B"), ("C", str(i % 2)))[i % 3])
    assert {r.read_id: r.genes for r in reads.collect()} == {q: sorted(g) for q, g in want.items() if g}
    parts = spark.createDataFrame([("A", "x"), ("B", "x"), ("C", "x")], "gene string, component string")
    torn = {q: len({"x" if g in "ABC" else g for g in s}) for q, s in want.items()}
    assert {r.read_id: r.n for r in counts.torn_reads(reads, parts).collect()} == {q: n for q, n in torn.items() if n > 1}


def test_reads_are_gone_through_once_for_their_components(spark, monkeypatch):
    rows = spark.range(400).selectExpr("concat('s', id % 2) AS sample", "concat('q', id % 300) AS read_id", "concat('G', id % 300 % 3, CASE WHEN id % 300 % 3 = 0 THEN ',G9' ELSE '' END, ',F+R') AS gene", "CASE WHEN id % 5 > 0 THEN concat('u', id % 5) END AS final_umi")
    met, cooccurrence = [], counts.cooccurrence
    monkeypatch.setattr(counts, "cooccurrence", lambda reads: met.append(reads.count()) or cooccurrence(reads))
    for dedup in (True, False):
        want = {}
        tags = {}
        for i in range(400):
            key = f"s{i % 2}", i % 300
            tags[key] = min(tags.get(key, "z"), f"u{i % 5}" if i % 5 else "")
        for (sample, q), tag in tags.items():
            want.setdefault((sample, "G0|G9" if q % 3 == 0 else f"G{q % 3}"), []).append(tag)
        got = {(r["sample"], r.component): r.n for r in counts.normalized_counts(rows, dedup).collect()}
        assert got == {k: len(set(t)) if dedup else len(t) for k, t in want.items()}
    assert met == [3, 3]
