"""Overlaps of intervals, by bins of several sizes: reads on exons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bits of the smallest bin.
LEAST_BITS = 6
#: Right rows up to this number are broadcast.
BROADCAST_ROWS = 200_000


def _bits(length: Column) -> Column:
    """Bits of the smallest bin that is as long as an interval."""
    return F.greatest(F.lit(LEAST_BITS), F.ceil(F.log2(length.cast("double"))).cast("int"))


def overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of rows on one ``contig`` whose inclusive ``start``, ``end`` overlap; other columns must not clash.

    A right row lies in bins of its own length, two at most, so a long one takes no more of them than a short one and a bin holds
    no more than what is about as long as itself. A left row probes the bins of each size that the right side has. A
    pair is kept in the first bin that both touch alone, so none comes twice and nothing is deduplicated afterwards.
    """
    right = right.where("start <= end").withColumn("__bits", _bits(F.col("end") - F.col("start") + 1))
    sizes = [r[0] for r in right.select("__bits").distinct().collect()]  # at most one a power of two
    at = F.expr("shiftright(cast(start AS bigint), __bits)"), F.expr("shiftright(cast(end AS bigint), __bits)")

    def binned(df: DataFrame, side: str) -> DataFrame:
        bins = df.withColumn("__bin", F.explode(F.sequence(*at))).withColumn(f"__first_{side}", at[0])
        return bins.withColumnsRenamed({"start": f"{side}_start", "end": f"{side}_end"})

    probes = left.where("start <= end").withColumn("__bits", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")))
    held = binned(right, "right")
    if right.count() <= BROADCAST_ROWS:
        held = F.broadcast(held)
    met = binned(probes, "left").join(held, ["contig", "__bits", "__bin"])
    once = F.col("__bin") == F.greatest("__first_left", "__first_right")
    near = once & (F.col("left_start") <= F.col("right_end")) & (F.col("right_start") <= F.col("left_end"))
    return met.where(near).drop("__bin", "__bits", "__first_left", "__first_right")


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, start, end): intervals of equal keys that overlap, as one. What overlaps an interval of a key overlaps one of these, and no other does."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = rows.where("start <= end").select(*keys, "start", "end").distinct().withColumn("__first", F.coalesce(F.col("start") > before, F.lit(True)).cast("long"))
    numbered = apart.withColumn("__run", F.sum("__first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__run")


def assign_genes(reads: DataFrame, exons: DataFrame) -> DataFrame:
    """(read_id, gene): the sorted genes whose exons a read overlaps, comma-joined; ``Unassigned`` for none.

    Exons of a gene are merged and equal places of reads looked up once, so neither deep exons nor deep reads multiply rows.
    """
    rows = reads.select("read_id", "contig", "start", "end")
    hits = overlaps(rows.select("contig", "start", "end").distinct(), merged(exons.where("gene is not null"), "gene", "contig"))
    fits = hits.groupBy(F.col("contig").alias("of_contig"), F.col("left_start").alias("of_start"), F.col("left_end").alias("of_end")).agg(F.collect_set("gene").alias("genes"))
    told = rows.join(fits, (F.col("contig") == F.col("of_contig")) & (F.col("start") == F.col("of_start")) & (F.col("end") == F.col("of_end")), "left")
    found = told.groupBy("read_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("genes")))).alias("genes"))
    return found.select("read_id", F.when(F.size("genes") > 0, F.array_join("genes", ",")).otherwise("Unassigned").alias("gene"))
