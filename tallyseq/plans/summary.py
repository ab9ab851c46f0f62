"""Depth per processing stage and the order that stages must keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (parent, child): a parent's count is never below its child's. A missing side skips the edge.
EDGES = (
    ("total_r1", "not_na_adapter"),
    ("not_na_adapter", "good_umi"),
    ("total_r1", "mapped"),
    ("total_r1", "assigned"),
    ("good_umi", "counted"),
    ("mapped", "counted"),
    ("counted", "counted_assigned"),
    ("assigned", "counted_assigned"),
    ("n_umi", "n_genes"),
)


def depth_table(totals: DataFrame, molecules: DataFrame) -> DataFrame:
    """One row per sample that any source knows; a source without the sample leaves nulls."""
    matrix = molecules.where("n > 0").groupBy("sample").agg(F.sum("n").alias("n_umi"), F.count("*").alias("n_genes"))
    return totals.join(matrix, "sample", "full")


def with_violations(table: DataFrame, edges: tuple[tuple[str, str], ...] = EDGES) -> DataFrame:
    """Add the edges that a sample breaks, comma-joined."""
    broken = [F.when(F.col(a) < F.col(b), F.lit(f"{a}<{b}")) for a, b in edges]
    return table.withColumn("violations", F.concat_ws(",", *broken))


def assert_order(table: DataFrame, edges: tuple[tuple[str, str], ...] = EDGES) -> DataFrame:
    """The table, which fails when it is read if a sample breaks an edge."""
    told = F.concat(F.col("sample"), F.lit(": "), F.col("violations"))
    checked = with_violations(table, edges)
    return checked.where(F.when(F.col("violations") != "", F.raise_error(told).cast("boolean")).otherwise(True)).drop("violations")


#: The metrics of a run's summary, in order, and the pairs of which the first is never below the second.
METRICS = ("raw", "pass_qc", "long_read", "not_na_adapter", "good_umi", "mapped", "assigned", "counted", "counted_assigned", "n_umi", "n_genes")
RUN_EDGES = (
    ("raw", "pass_qc"),
    ("pass_qc", "long_read"),
    ("long_read", "not_na_adapter"),
    ("not_na_adapter", "good_umi"),
    ("long_read", "mapped"),
    ("mapped", "assigned"),
    ("good_umi", "counted"),
    ("mapped", "counted"),
    ("counted", "counted_assigned"),
    ("assigned", "counted_assigned"),
    ("counted_assigned", "n_umi"),
    ("n_umi", "n_genes"),
)


def run_summary(raw: DataFrame | None = None, trimmed: DataFrame | None = None, aligner: DataFrame | None = None, tagger: DataFrame | None = None, molecules: DataFrame | None = None) -> DataFrame:
    """One row per sample that any source knows, with all metrics; what no source tells is null.

    ``raw`` (sample, raw), ``trimmed`` (sample, pass_qc), ``aligner`` (sample, long_read), ``tagger``
    (sample, metrics map) and ``molecules`` (sample, feature, n) may be absent. A long table of
    metrics is pivoted once, so adding a source adds no join.
    """
    long = []
    for name, df in (("raw", raw), ("pass_qc", trimmed), ("long_read", aligner)):
        if df is not None:
            long.append(df.select("sample", F.lit(name).alias("metric"), F.col(name).alias("value")))
    if tagger is not None:
        long.append(tagger.select("sample", F.explode("metrics").alias("metric", "value")))
    if molecules is not None:
        found = molecules.groupBy("sample").agg(F.sum("n").alias("n_umi"), F.count_if(F.col("n") > 0).alias("n_genes"))
        long.append(found.unpivot("sample", ["n_umi", "n_genes"], "metric", "value"))
    if not long:
        raise ValueError("no source is given")
    rows = long[0]
    for more in long[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("sample").pivot("metric", [*METRICS]).agg(F.max("value")).select("sample", *METRICS)


def strict_differences(table: DataFrame, groups: DataFrame, raw_matrix: DataFrame) -> DataFrame:
    """Samples whose counted reads differ from their grouped rows or from their raw counts, with what differs."""
    rows = groups.groupBy("sample").agg(F.count("*").alias("rows"), F.count_if(~F.col("gene").startswith("Unassigned,")).alias("assigned_rows"))
    sums = raw_matrix.groupBy("sample").agg(F.sum("n").alias("matrix_sum"))
    pairs = (("counted", "rows"), ("counted_assigned", "assigned_rows"), ("counted_assigned", "matrix_sum"))
    both = table.join(rows, "sample", "left").join(sums, "sample", "left")
    told = F.concat_ws(",", *[F.when(F.col(a) != F.col(b), F.lit(f"{a}<>{b}")) for a, b in pairs])
    return both.select("sample", told.alias("differences")).where("differences <> ''")
