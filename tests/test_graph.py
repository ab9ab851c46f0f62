"""Connected components and joins with hot keys."""

from pyspark.sql import functions as F

from tallyseq.operators import skew
from tallyseq.operators.graph import connected_components
from tallyseq.operators.skew import hot_limit, join_hot


def test_star_and_path(spark):
    star = spark.range(1, 100_001).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    path = spark.range(200_000, 200_012).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = connected_components(star.union(path)).groupBy("component").count().collect()
    assert sorted(map(tuple, got)) == [(0, 100_001), (200_000, 13)]


def test_odd_edges(spark):
    edges = spark.createDataFrame([(1, 1), (2, None), (3, 4), (4, 3), (3, 4)], "src long, dst long")
    assert sorted(map(tuple, connected_components(edges).collect())) == [(3, 3), (4, 3)]
    assert connected_components(edges.limit(0)).count() == 0


def test_hot_join_equals_plain_join(spark, monkeypatch):
    rows = spark.range(1000).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), "id")
    per_key = rows.groupBy("k").agg(F.count("*").alias("members"), F.max("id").alias("top"))
    monkeypatch.setattr(skew, "SMALL", 0)
    got = join_hot(rows, per_key, "k", 1000).select("id", "k", "top")
    want = rows.join(per_key, "k").select("id", "k", "top")
    assert got.count() == 1000 and got.exceptAll(want).count() == 0
    assert hot_limit(10**10) * 20_000 >= 10**10
