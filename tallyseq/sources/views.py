"""The test tables seen in the domain's schemas: reads, alignments and sequences derived by fixed rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.session import spread

BASES = ("0123456789abcdef", "ACGTACGTACGTACGT")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table dealt by the first one: where much is made of each row, a file of few row groups must not be the work of few tasks."""
    return spread(table(spark, sf_dir, name).select(*columns), columns[0])


def umi_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as grouped reads: sample, read_id, gene (genes and a primer pair, comma-joined), final_umi."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('s', l_orderkey % 6) AS sample",
        "concat(l_orderkey, '_', l_linenumber) AS read_id",
        """concat(CASE WHEN l_partkey % 7 = 0 THEN 'Unassigned,'
               ELSE concat('G', l_partkey % 40, CASE WHEN l_partkey % 5 = 0 THEN concat(',G', l_suppkey % 40) ELSE '' END, ',') END,
           'F', l_suppkey % 5, '+R', l_suppkey % 3) AS gene""",
        "lpad(cast(l_orderkey % 997 AS string), 4, '0') AS final_umi",
    )


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as counts (sample, feature, n) of twelve samples, odd ones with other depths and one feature less."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey % 12 AS s", "l_partkey % 60 AS f").where("f <> 59 OR s % 2 = 0")
    return rows.groupBy("s", "f").agg(F.count("*").alias("n")).selectExpr("concat('s', s) AS sample", "concat('G', f) AS feature", "n * (1 + f % 5 * (1 + s % 2)) AS n")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as alignment records, some mates and some repeated primaries, in order ``ord``."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('s', l_orderkey % 6) AS sample",
        "l_linenumber AS ord",
        """concat('q', l_orderkey, '_', translate(lpad(cast(l_orderkey % 1000000 AS string), 6, '0'), '0123456789', 'ACGTACGTAN'), '_',
           translate(lpad(cast(l_orderkey % 99991 AS string), 6, '0'), '0123456789', 'ACGTACGTAC'), '_F', l_orderkey % 11, '+',
           CASE WHEN l_orderkey % 13 = 0 THEN 'no_adapter' ELSE concat('R', l_orderkey % 11) END) AS qname""",
        "cast(CASE l_linenumber % 4 WHEN 0 THEN 147 WHEN 1 THEN 99 WHEN 2 THEN 355 ELSE 69 END AS int) AS flag",
        "CASE WHEN l_partkey % 3 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN 'Unassigned' WHEN l_partkey % 5 = 0 THEN concat('G', l_partkey % 9, ',G', l_suppkey % 9) ELSE concat('G', l_partkey % 9) END AS xt",
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as transcripts of 64 bases."""
    return dealt(spark, sf_dir, "part", "p_partkey").select(
        F.col("p_partkey").alias("seq_id"),
        F.translate(F.concat(F.md5(F.col("p_partkey").cast("string")), F.md5(F.concat(F.lit("x"), F.col("p_partkey").cast("string")))), *BASES).alias("seq"),
    )


def primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as primers of 14 bases cut from transcripts: one forward and one reverse each."""
    cut = F.translate(F.md5(F.col("s_suppkey").cast("string")), *BASES)
    rows = dealt(spark, sf_dir, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("pair_id"), F.substring(cut, 3, 14).alias("fwd"), F.reverse(F.translate(F.substring(cut, 19, 14), "ACGT", "TGCA")).alias("rev"))
    return rows.select("pair_id", F.expr("stack(2, 'fwd', fwd, 'rev', rev) AS (primer_type, primer_seq)"))


def read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as read pairs: tags of six bases (seven for some), a primer of eight, and a rest; some matched no primer."""
    bases = "translate(md5(cast({} AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
    rows = dealt(spark, sf_dir, "orders", "o_orderkey").selectExpr("o_orderkey AS k", f"{bases.format('o_orderkey')} AS b1", f"{bases.format('o_orderkey + 7')} AS b2")
    return rows.selectExpr(
        "concat('s', k % 6) AS sample",
        "concat('q', k) AS read_id",
        "concat(substring(b1, 1, 6 + cast(k % 17 = 0 AS int)), 'TTGGTTGG', substring(b1, 9, 24)) AS r1_seq",
        "repeat('I', 38 + cast(k % 17 = 0 AS int)) AS r1_qual",
        "concat(substring(b2, 1, 6), 'GGTTGGTT', substring(b2, 9, 24)) AS r2_seq",
        "repeat('F', 38) AS r2_qual",
        "CASE WHEN k % 13 = 0 THEN '' ELSE 'TTGGTTGG' END AS match1",
        "'GGTTGGTT' AS match2",
        "CASE WHEN k % 13 = 0 THEN 'no_adapter' ELSE concat('F', k % 11) END AS adapter1",
        "concat('R', k % 11) AS adapter2",
    )


#: Primers of a panel for each supplier.
PANEL_EACH = 5


def panel(spark: SparkSession, sf_dir: str, mate: str) -> DataFrame:
    """Suppliers as five primers each, of 20 to 24 bases; ``mate`` is F or R and begins their names."""
    rows = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS k", f"explode(sequence(0, {PANEL_EACH - 1})) AS j")
    rows = rows.selectExpr("k", "j", f"concat('{mate}', k, '_', j) AS adapter")
    return rows.select("adapter", F.translate(F.substring(F.md5("adapter"), F.lit(1), (20 + (F.col("k") + F.col("j")) % 5).cast("int")), *BASES).alias("primer"))


def primed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pairs of reads, each with a primer of its panel: whole, with errors of each kind, cut at the read's start, or none."""
    bases = "translate(md5(concat('{}', o_orderkey)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
    rows = dealt(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    for mate, number, shift in (("F", 1, 0), ("R", 2, 3)):
        key = f"concat('{mate}', (o_orderkey + {shift}) % 100 + 1, '_', o_custkey % {PANEL_EACH})"
        rows = rows.join(panel(spark, sf_dir, mate).selectExpr("adapter AS of", f"primer AS p{number}").withColumnRenamed("of", f"of{number}"), F.expr(key) == F.col(f"of{number}"), "left")
        p, kind = f"coalesce(p{number}, '')", f"(o_orderkey + {shift}) % 8"
        changed = f"""CASE {kind} WHEN 0 THEN {p} WHEN 1 THEN concat(substring({p}, 1, 9), 'A', substring({p}, 11)) WHEN 2 THEN concat(substring({p}, 1, 6), substring({p}, 8))
            WHEN 3 THEN concat(substring({p}, 1, 11), 'G', substring({p}, 12)) WHEN 4 THEN concat(substring({p}, 1, 4), 'T', substring({p}, 6, 9), 'C', substring({p}, 16))
            WHEN 5 THEN substring({p}, 2) WHEN 6 THEN concat('G', substring({p}, 2, 8), 'G', substring({p}, 11, 7), 'G', substring({p}, 19)) ELSE '' END"""
        before = f"CASE WHEN {kind} = 5 THEN '' ELSE substring({bases.format(f'a{number}')}, 1, cast(o_custkey % 7 AS int)) END"
        rows = rows.withColumn(f"r{number}_seq", F.expr(f"concat({before}, {changed}, substring({bases.format(f'b{number}')}, 1, 24))"))
    return rows.selectExpr("concat('q', o_orderkey) AS read_id", "r1_seq", "r2_seq")


#: Letters that stand for good and for bad qualities.
GOOD, BAD = "IHGFEDCBA@?>=<;:", "#$%&'()*+,-./012"
ADAPTERS = ("AGATCGGAAGAGCACACG", "AGATCGGAAGAGCGTCGT")


def quality_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pairs of reads of 48 bases: an insert, an adapter that some miss a base of or have one wrong, and a tail of varied quality."""
    rows = dealt(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    out = ["concat('q', o_orderkey) AS read_id"]
    for k, adapter in enumerate(ADAPTERS, 1):
        bases = f"translate(concat(md5(concat('i{k}', o_orderkey)), md5(concat('t{k}', o_orderkey))), '{BASES[0]}', '{BASES[1]}')"
        kind = f"(o_orderkey + {k}) % 6"
        worn = f"CASE {kind} WHEN 0 THEN '' WHEN 1 THEN concat(substring('{adapter}', 1, 3), 'A', substring('{adapter}', 5)) WHEN 2 THEN concat(substring('{adapter}', 1, 7), substring('{adapter}', 9)) ELSE '{adapter}' END"
        insert = f"substring({bases}, 1, 20 + cast(o_custkey % 29 AS int))"
        marks = f"concat(md5(concat('q{k}', o_orderkey)), md5(concat('r{k}', o_orderkey)))"
        good = f"(44 - cast((o_custkey + {k}) % 17 AS int))"
        qual = f"concat(translate(substring({marks}, 1, {good}), '{BASES[0]}', '{GOOD}'), translate(substring({marks}, {good} + 1, 48 - {good}), '{BASES[0]}', \"{BAD}\"))"
        out += [f"substring(concat({insert}, {worn}, substring({bases}, 33)), 1, 48) AS r{k}_seq", f"substring({qual}, 1, length(substring(concat({insert}, {worn}, substring({bases}, 33)), 1, 48))) AS r{k}_qual"]
    return rows.selectExpr(*out)
