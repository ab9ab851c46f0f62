"""Statistics of count tables in long form (sample, feature, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.operators.ranks import global_rank
from tallyseq.operators.skew import join_hot

#: Ranks of a block.
BLOCK = 65_536


def quantile_normalize(values: DataFrame) -> DataFrame:
    """Give every sample the mean distribution: a value becomes the mean over samples of its rank, ties their mean.

    The table is dense, as every rank must have a value from each sample. Ranks come from one global order, so a sample of any
    number of features is sorted by many tasks; samples and ties of many cells meet their row by a bounded broadcast.
    """
    ranked = global_rank(values, F.col("sample"), F.col("value"), F.col("feature"))
    total = ranked.count()
    firsts = ranked.groupBy("sample").agg(F.min("rank").alias("first"), F.count("*").alias("members"))
    placed = join_hot(ranked, firsts, "sample", total).withColumn("rank", F.col("rank") - F.col("first"))
    means = placed.groupBy("rank").agg(F.avg("value").alias("mean"))
    met = placed.select("sample", "feature", "value", "rank").join(means, "rank")
    tied = met.groupBy("sample", "value").agg(F.avg("mean").alias("out"), F.count("*").alias("members"))
    return join_hot(met.select("sample", "feature", "value"), tied, ["sample", "value"], total).select("sample", "feature", F.col("out").alias("value"))


def adjust_fdr(rows: DataFrame, by: str, p: str = "p", key: str = "id") -> DataFrame:
    """Benjamini-Hochberg adjusted values ``q`` within ``by``: the least p * n / rank from a row's rank on.

    Ranks come from a global order by family, value and key, so a family of any size is sorted by many tasks. The running
    minimum is taken in blocks of ranks; the minima of later blocks, one row a block, are carried to the earlier ones.
    Null is a family like any other.
    """
    rows, whole = rows.withColumns({"__none": F.col(by).isNull(), "__family": F.col(by)}), rows.columns
    keys = ["__none", "__key"]
    kind = rows.schema["__family"].dataType
    filler = {"string": F.lit("")}.get(kind.simpleString(), F.lit(0).cast(kind))  # joins and windows see no null
    rows = rows.withColumn("__key", F.coalesce("__family", filler)).drop("__family")
    ranked = global_rank(rows, *[F.col(k) for k in keys], F.col(p), F.col(key), name="__rank")
    families = ranked.groupBy(*keys).agg(F.count("*").alias("__n"), F.min("__rank").alias("__first"))
    placed = join_hot(ranked, families, keys, ranked.count(), "__n").withColumn("__block", F.expr(f"__rank div {BLOCK}"))
    valued = placed.withColumn("__v", F.col(p) * F.col("__n") / (F.col("__rank") - F.col("__first") + 1))
    later = Window.partitionBy(*keys).orderBy(F.col("__block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = valued.groupBy(*keys, "__block").agg(F.min("__v").alias("__least")).select(*keys, "__block", F.min("__least").over(later).alias("__later"))
    own = F.min("__v").over(Window.partitionBy(*keys, "__block").orderBy(F.col("__rank").desc()))
    sized = valued.withColumn("__own", own).join(carried, [*keys, "__block"])
    q = F.least(F.lit(1.0), F.col("__own"), F.coalesce("__later", F.lit(1.0)))
    return sized.select(*whole, q.alias("q"))


def top_deviating(values: DataFrame, top: int) -> DataFrame:
    """The ``top`` features by standard deviation over the samples of a dense table."""
    return values.groupBy("feature").agg(F.stddev_samp("value").alias("sd")).orderBy(F.desc("sd"), "feature").limit(top)


def counts_from_log2_cpm(value: Column, depth: Column, total: Column, prior: float = 1.0) -> Column:
    """The counts behind log2 values, rounded half to even; negatives are 0."""
    return F.greatest(F.bround((F.pow(F.lit(2.0), value) - prior) * depth / total, 0), F.lit(0.0)).cast("long")


def reverse_log2_cpm(values: DataFrame, counts: DataFrame, prior: float = 1.0) -> DataFrame:
    """Counts (sample, feature, n) behind log2 values per million; depths come from ``counts``."""
    depth = counts.groupBy("sample").agg(F.sum("n").alias("depth"))
    total = depth.agg(F.least(F.avg("depth"), F.lit(1e6)).alias("total"))
    rows = values.join(depth, "sample").crossJoin(F.broadcast(total))
    return rows.select("sample", "feature", counts_from_log2_cpm(F.col("value"), F.col("depth"), F.col("total"), prior).alias("n"))


def common_features(counts: DataFrame, batches: DataFrame) -> DataFrame:
    """Features with a count in every batch; ``batches`` maps sample to batch."""
    seen = counts.where("n > 0").join(batches, "sample").select("feature", "batch").distinct().groupBy("feature").agg(F.count("*").alias("seen"))
    every = batches.select("batch").distinct().agg(F.count("*").alias("every"))
    return seen.crossJoin(F.broadcast(every)).where("seen = every").select("feature")


def size_factors(counts: DataFrame) -> DataFrame:
    """Median of ratios: per sample, the median over features of its count to their geometric mean.

    Only features with a count in every sample take part. ``counts`` holds one row per cell above zero.
    """
    samples = counts.select("sample").distinct().agg(F.count("*").alias("samples"))
    means = counts.where("n > 0").groupBy("feature").agg(F.avg(F.log("n")).alias("log_mean"), F.count("*").alias("cells")).crossJoin(F.broadcast(samples)).where("cells = samples").select("feature", "log_mean")
    ratios = counts.join(means, "feature").groupBy("sample").agg(F.percentile(F.log("n") - F.col("log_mean"), F.lit(0.5)).alias("middle"))
    return ratios.select("sample", F.exp("middle").alias("size_factor"))


def center_batches(values: DataFrame, batches: DataFrame) -> DataFrame:
    """Take each feature's batch means away and put its overall mean back: the least-squares removal of one factor."""
    rows = values.join(batches, "sample")
    own = F.avg("value").over(Window.partitionBy("feature", "batch"))
    return rows.select("sample", "feature", (F.col("value") - own + F.avg("value").over(Window.partitionBy("feature"))).alias("value"))
