"""From an ordered pool to its pairs, end to end; draws and correction as commands; group matching."""

import random

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyseq.__main__ import main
from tallyseq.operators import counts, pairing, primers, recover, stats
from tallyseq.plans import design, registry
from tallyseq.sources import files


def flip(seq):
    return seq[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_recover_command(spark, tmp_path):
    dice = random.Random(2)
    some = lambda n: "".join(dice.choice("ACGT") for _ in range(n))
    left, right = some(20), some(22)
    body = some(30) + left + some(60) + flip(right) + some(10)
    (tmp_path / "t.fa").write_text(f">T1.1|G1.1|a|b|c|GENE1\n{body}\n>T2.1|G1.1|a|b|c|GENE1\n{some(5)}{body}\n>T3\n{some(300)}\n")
    rows = [("pool1", recover.PREFIXES["fwd"] + "ACATCA" + left), ("pool2", recover.PREFIXES["rev"] + "ATAGTT" + right)]
    (tmp_path / "o.tsv").write_text("Pool name\tSequence\n" + "".join(f"{a}\t{b}\n" for a, b in rows))
    main(["recover", f"{tmp_path}/o.tsv", f"{tmp_path}/t.fa", f"{tmp_path}/out", "--linkers", "--low", "50", "--high", "150"])
    (got,) = spark.read.csv(f"{tmp_path}/out", sep="\t", header=True).collect()
    assert (got.gene_symbol, got.gene_id, got.l_pool, got.r_pool) == ("GENE1", "G1", "pool1", "pool2")
    assert got.multi_mapping == "T1.1|G1.1|GENE1|31|50|111|132|102;T2.1|G1.1|GENE1|36|55|116|137|102"
    assert got.order_forward.endswith(left) and got.order_reverse.endswith(right)
    checks = {r.check: int(r.n) for r in spark.read.csv(f"{tmp_path}/out_checks", sep="\t", header=True).collect()}
    assert checks["pairs across pools"] == 1 and checks["primers ordered twice"] == 0
    main(["recover", f"{tmp_path}/o.tsv", f"{tmp_path}/t.fa", f"{tmp_path}/none", "--linkers", "--low", "500"])
    assert spark.read.csv(f"{tmp_path}/none", sep="\t", header=True).count() == 0


def test_a_primer_of_two_pools_is_refused(spark):
    names = "primer_seq_fwd string, primer_seq_rev string, transcript_id string, gene_id string, gene_symbol string, start_up int, end_up int, start_down int, end_down int, amplicon_length int, pool_fwd string, pool_rev string"
    rows = [("A", "C", "t", "g", "s", 1, 2, 5, 6, 6, p, "q") for p in ("p1", "p2")]
    with pytest.raises(PySparkException, match="several pools of fwd"):
        recover.list_pairs(spark.createDataFrame(rows, names)).collect()
    assert recover.list_pairs(spark.createDataFrame([], names)).count() == 0


def test_bounds_of_words(spark):
    pool = spark.createDataFrame([(1, "ACGTNACGT")], "id int, seq string")
    for how in ((0, 4), (5, 4), (4, 8, -1)):
        with pytest.raises(ValueError, match="len_min|window"):
            primers.complement_loads(pool, *how)
    with pytest.raises(PySparkException, match="primer 1"):
        primers.complement_hits(pool, 4, 4).collect()


def test_loads_equal_hits(spark):
    dice = random.Random(5)
    pool = spark.createDataFrame([(i, "".join(dice.choice("ACGT") for _ in range(dice.randint(3, 16)))) for i in range(25)], "id int, seq string")
    for window in (None, 2):
        want = {}
        for r in primers.complement_hits(pool, 4, 6, True, window).collect():
            for own in {r.id_1, r.id_2}:
                n, load = want.get(own, (0, 0.0))
                # places of a primer with itself are told once in each direction
                want[own] = n + 1, load + r.score / (2 if r.id_1 == r.id_2 else 1)
        got = {r.id: (r.hits, r.load) for r in primers.complement_loads(pool, 4, 6, window).collect()}
        assert set(got) == set(want)
        for k, (n, load) in want.items():
            assert got[k][0] == n and abs(got[k][1] - load) < 1e-9


def test_loads_shuffle_sums_and_no_words_of_primers(spark):
    dice = random.Random(6)
    half = ["".join(dice.choice("ACGT") for _ in range(12)) for _ in range(6)]
    turned = [s[::-1].translate(str.maketrans("ACGT", "TGCA")) for s in half]
    pool = spark.createDataFrame([*enumerate(half + turned), (12, None), (13, "AC")], "id int, seq string")
    plan = primers.complement_loads(pool)._jdf.queryExecution().executedPlan().toString()
    dealt = [x.split(")")[0] for x in plan.split("hashpartitioning(id#")[1:]]
    assert dealt and not any("kmer" in keys for keys in dealt)
    want = {}
    for r in primers.complement_hits(pool, 7, 11).collect():  # longer words are joined and not sent
        for own in {r.id_1, r.id_2}:
            n, load = want.get(own, (0, 0.0))
            want[own] = n + 1, load + r.score / (2 if r.id_1 == r.id_2 else 1)
    got = {r.id: (r.hits, r.load) for r in primers.complement_loads(pool, 7, 11).collect()}
    assert set(got) == set(want) and all(got[k][0] == n and abs(got[k][1] - load) < 1e-6 for k, (n, load) in want.items())


def test_rarefy_and_correct_commands(spark, tmp_path):
    dice = random.Random(1)
    (tmp_path / "m.csv").write_text("sample,x,y,z\n" + "".join(f"s{i},{dice.randint(20, 60)},{dice.randint(30, 90) * (1 + i % 2)},{dice.randint(5, 9)}\n" for i in range(6)))
    (tmp_path / "meta.tsv").write_text("sample\tto\n" + "".join(f"s{i}\t{'10' if i else 's5'}\n" for i in range(6)))
    main(["rarefy", f"{tmp_path}/m.csv", f"{tmp_path}/r.csv", "--metadata", f"{tmp_path}/meta.tsv", "--repeats", "2", "--key", "to"])
    sums = {r["sample"]: r.n for r in files.read_matrix(spark, f"{tmp_path}/r.csv").groupBy("sample").agg(F.sum("n").alias("n")).collect()}
    assert len(sums) in (11, 12) and all(n == 10 for s, n in sums.items() if not s.startswith("s0"))
    (tmp_path / "s.tsv").write_text("sample\tbatch\n" + "".join(f"s{i}\tb{i % 2}\n" for i in range(6)))
    main(["correct", f"{tmp_path}/m.csv", f"{tmp_path}/s.tsv", f"{tmp_path}/c.csv"])
    assert files.read_matrix(spark, f"{tmp_path}/c.csv").count() == 18


def test_matching_of_groups(spark):
    dice = random.Random(9)
    rows = spark.createDataFrame([(f"s{s}", f"f{f}", dice.randint(0, 50) * (1 + (f % 3 == 0) * (s % 2))) for s in range(8) for f in range(20)], "sample string, feature string, n long")
    groups = spark.createDataFrame([(f"s{s}", f"g{s % 2}") for s in range(8)], "sample string, group string")
    values = stats.quantile_normalize(counts.log2_cpm(counts.complete(rows, rows)))
    want = {(r["sample"], r.feature): r.value for r in pairing.pair_corrected(values, pairing.nearest(values, groups, 1, 5000)).collect()}
    got = {(r["sample"], r.feature): r.value for r in pairing.match_groups(rows, groups).collect()}
    assert set(got) == set(want) and all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    assert pairing.match_groups(rows, groups, reverse=True).agg(F.min("n")).first()[0] >= 0
    found = {r.feature: r.p for r in pairing.differential_features(rows, groups).collect()}
    assert found == {r.feature: r.p for r in pairing.regress_groups(pairing.match_groups(rows, groups), groups).collect()} and len(found) == 20
    with pytest.raises(ValueError, match="without a group"):
        pairing.match_groups(rows, groups.where("sample <> 's3'"))
    with pytest.raises(Exception, match="below 0"):  # the job that ranks the values raises it
        pairing.match_groups(rows.withColumn("n", -F.col("n") - 1), groups).collect()


def test_a_primer_of_two_pools_belongs_to_its_first_pair(spark, tmp_path):
    """Suppliers 26986 and 40749 have one forward primer and different pools."""
    for table, key in (("supplier", "s_suppkey"), ("part", "p_partkey")):
        spark.createDataFrame([(26986,), (40749,), (5,)], f"{key} long").write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    for table in ("supplier", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    found = design.pool_orders(spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in found.columns)} FROM ({design.oracle_sql()['pool_orders']})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) >= 3


def test_rarefied_molecules_are_dealt_to_all_cores(spark):
    rows = spark.createDataFrame([("s", "f", 100_000)], "sample string, feature string, n long")
    found = counts.rarefy(rows, 500)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("s", "f", 500)]


def test_rarefied_molecules_meet_no_join(spark):
    """A plan that runs guesses an exploded table as small as it was before, and sends it through the driver."""
    rows = spark.createDataFrame([(s, f, 9000 + 1000 * f) for s in ("a", "b") for f in range(4)] + [("c", 0, 7)], "sample string, feature int, n long")
    found = counts.rarefy(rows, 500, block=64)
    got = {(r["sample"], r.feature): r.n for r in found.collect()}
    sums = {s: sum(n for (of, _), n in got.items() if of == s) for s in "abc"}
    assert sums == {"a": 500, "b": 500, "c": 7}
    lines = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*|")) for x in lines]
    for i, line in enumerate(lines):
        if "Join" in line:
            below = lines[i + 1 : next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))]
            assert not any("Generate" in x for x in below)


def test_groups_of_pairs_shuffle_amplicons_once(spark):
    rows = spark.createDataFrame([("A", "C", "g2", "t2", 1, 9), ("A", "C", "g1", "t1", 5, 9), ("A", "C", "g1", "t1", 2, 9), ("A", "C", None, "t3", 1, 2)], "fwd string, rev string, gene_id string, transcript_id string, start int, end int")
    found = recover.group_pairs(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1
    assert [(r.num_transcripts, r.num_genes, r.num_amplicons, r.transcript_id_all) for r in found.collect()] == [(3, 2, 4, "t1;t2;t3")]


def test_groups_are_made_behind_the_shuffle_of_places(spark):
    dice = random.Random(8)
    seqs = [(i, "".join(dice.choice("ACGT") for _ in range(dice.choice([3, 40, 60])))) for i in range(40)] + [(40, None), (41, "acgtacgtTTTTacgtacgt")]
    transcripts = spark.createDataFrame(seqs, "seq_id int, seq string")
    patterns = spark.createDataFrame([("".join(dice.choice("ACGT") for _ in range(n)),) for n in (3, 3, 3, 4, 4, 5) * 3] + [("acgt",), ("ACGT",)], "pattern string")
    gene, transcript = F.concat(F.lit("g"), F.col("seq_id") % 3), F.concat(F.lit("t"), F.col("seq_id") % 30)
    found = recover.group_facing(transcripts, patterns, gene, transcript)
    located = primers.locate(transcripts, patterns).withColumn("primer_type", F.lit("fwd"))
    named = primers.amplicons(located).select(F.col("up").alias("fwd"), F.col("down").alias("rev"), gene.alias("gene_id"), transcript.alias("transcript_id"), F.col("up_start").alias("start"), F.col("down_end").alias("end"))
    want = recover.group_pairs(named)
    assert found.dtypes == want.dtypes and sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and want.count() > 100
    assert recover.group_facing(transcripts, patterns.limit(0), gene, transcript).count() == 0


def test_amplicons_pass_no_shuffle(spark):
    plan = registry.queries()["amplicon_groups"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    above, dealt, _ = plan.partition("hashpartitioning(fwd")
    assert dealt and "Generate" in above and "Exchange hash" not in above.rpartition("\n")[0]
