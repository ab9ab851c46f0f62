"""Mixing sources to target weights: capped water-filling and seeded repetition.

Every step is a DataFrame aggregate, join or window; no Python runs on the executors.
Sources are ranked by range partitions and offsets, water is filled by repeated small
aggregates over one row per source, and the fractional repetition of a source is a prefix
of its documents in the order of a seeded hash. The end of that prefix is found by two
levels of hash buckets and a window over the last bucket, so no task sorts a source.

Defined results for odd input: a null text has size 0; a text of any length counts whole; null is a source of its own and
ranks last; sources without words have target 0 and are taken not at all; rows that repeat
an id in a source share their decision, as do ids of equal hash in order of the id; an empty table gives an empty result.
``mix_table`` ignores other columns, and an id column named like an output column comes out as name + ``_input``;
``mix_documents`` returns the columns of ``docs`` as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.llm.names import clear_of
from tallyseq.session import materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
LEVEL_BITS = 10
#: Sources up to this number are broadcast to their documents; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(id_col: str, seed: int) -> Column:
    """A document's place in the seeded order: 63 bits of a hash of its id."""
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)), 1)


def ranked_sources(totals: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0) by code point, null last, without a single sorting task."""
    ranged = materialize(totals.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()))
    order = Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")
    offsets = ranged.groupBy("part").agg(F.count("*").alias("rows")).withColumn("before", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranged.withColumn("place", F.row_number().over(order) - 1).join(F.broadcast(offsets.select("part", "before")), "part").select("source", "source_size", (F.col("before") + F.col("place")).alias("rank"))


def water_fill(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to one row per source: shares by weight, clamped at ``max_epochs`` sizes, the excess reshared."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = materialize(ranked_sources(totals).withColumn("weight", F.get(cycle, (F.col("rank") % len(weights)).cast("int"))).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size")))
    first = rows.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    level, clamped = (first["words"] / first["weight"] if first["weight"] else 0.0), -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        now = rows.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if now["n"] == clamped or not now["open"]:
            break
        clamped, level = now["n"], (first["words"] - (now["held"] or 0.0)) / now["open"]
    return rows.select("source", "source_size", F.when(full, F.col("cap")).otherwise(F.lit(level) * F.col("weight")).alias("target"))


def repetitions(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``whole`` copies of every document, and one more up to (``last_draw``, ``last_id``) in seeded order.

    ``sized`` has ``id``, ``source``, ``size`` and ``place``.
    """
    base = F.floor(F.col("target") / F.col("source_size"))
    plan = targets.withColumn("whole", F.when(F.col("source_size") > 0, base).otherwise(0).cast("long"))
    plan = materialize(plan.withColumn("need", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))))
    shift = 63 - LEVEL_BITS
    level1 = F.shiftright("place", shift)
    level2 = F.shiftright("place", shift - LEVEL_BITS).bitwiseAND((1 << LEVEL_BITS) - 1)

    def boundary(sums: DataFrame, of: DataFrame, name: str) -> DataFrame:
        """The bucket in which a source's need ends, and what is needed of it."""
        w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        ends = sums.withColumn("end", F.sum("words").over(w)).withColumnRenamed("source", "of")
        met = of.join(ends, of["source"].eqNullSafe(ends["of"])).where("end > need")
        found = met.groupBy("source").agg(F.min(F.struct("bucket", (F.col("need") - F.col("end") + F.col("words")).alias("rest"))).alias("m"))
        return found.select("source", F.col("m.bucket").alias(name), F.col("m.rest").alias("need"))

    def inside(rows: DataFrame, of: DataFrame, bucket: Column, name: str) -> DataFrame:
        at = of.select(F.col("source").alias("of"), F.col(name).alias("at"), "need")
        return rows.join(at, rows["source"].eqNullSafe(at["of"]) & (bucket == F.col("at"))).drop("of", "at")

    open_ = plan.where("need > 0").select("source", "need")
    sums1 = sized.groupBy("source", level1.alias("bucket")).agg(F.sum("size").alias("words"))
    b1 = materialize(boundary(sums1, open_, "b1"))
    rows1 = inside(sized, b1, level1, "b1").drop("need")
    sums2 = rows1.groupBy("source", level2.alias("bucket")).agg(F.sum("size").alias("words"))
    b2 = materialize(boundary(sums2, b1.select("source", "need"), "b2"))
    rows2 = inside(rows1, b2, level2, "b2")
    order = Window.partitionBy("source").orderBy("place", "id").rowsBetween(Window.unboundedPreceding, 0)
    taken = rows2.withColumn("end", F.sum("size").over(order)).where(F.col("end") - F.col("size") / 2 <= F.col("need"))
    last = taken.groupBy("source").agg(F.max(F.struct("place", "id")).alias("last"))
    edge = b1.join(b2.select(F.col("source").alias("s2"), "b2"), F.col("source").eqNullSafe(F.col("s2")), "left")
    floor_place = F.shiftleft("b1", shift) + F.coalesce(F.shiftleft("b2", shift - LEVEL_BITS), F.lit(0))
    edge = edge.select("source", floor_place.alias("from_place")).withColumnRenamed("source", "s1")
    last = last.withColumnRenamed("source", "s3")
    done = plan.join(edge, plan["source"].eqNullSafe(F.col("s1")), "left").join(last, plan["source"].eqNullSafe(F.col("s3")), "left")
    return materialize(
        done.select(
            "source",
            "source_size",
            "target",
            "whole",
            F.coalesce(F.col("last.place"), F.col("from_place") - 1, F.lit(-1)).alias("last_draw"),
            F.col("last.id").alias("last_id"),
        )
    )


def mixing_plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, weights: tuple[int, ...], max_epochs: int) -> tuple[DataFrame, DataFrame]:
    """The sized documents (one narrow row each) and the repetitions of each source."""
    sized = materialize(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), draw(id_col, seed).alias("place")))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return sized, repetitions(sized, water_fill(totals, weights, max_epochs))


def _extra(place: Column, id_: Column) -> Column:
    """Whether a document lies in the prefix that is taken once more."""
    return (place < F.col("last_draw")) | ((place == F.col("last_draw")) & F.coalesce(id_ <= F.col("last_id"), F.col("last_id").isNull() | id_.isNull()))


def mix_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (words)."""
    sized, plan = mixing_plan(docs, id_col, text_col, source_col, seed, weights, max_epochs)
    plan = plan.withColumnRenamed("source", "of")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = sized.join(plan, sized["source"].eqNullSafe(plan["of"]))
    own = clear_of(docs.select(id_col), "size", "source_size", "target", "copies", "taken").columns[0]
    copies = F.col("whole") + _extra(F.col("place"), F.col("id")).cast("long")
    return rows.select(F.col("id").alias(own), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixture itself: each document's row as often as it is taken, with the columns of ``docs``."""
    names = docs.columns
    _, plan = mixing_plan(docs, id_col, text_col, source_col, seed, weights, max_epochs)
    plan = plan.select(F.col("source").alias("__of"), F.col("whole"), "last_draw", "last_id")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col(source_col).alias("__source"), F.col(id_col).alias("__id"), draw(id_col, seed).alias("__place"))
    rows = rows.join(plan, rows["__source"].eqNullSafe(plan["__of"]))
    copies = F.col("whole") + _extra(F.col("__place"), F.col("__id")).cast("long")
    return rows.withColumn("__copies", copies).where("__copies > 0").select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select("__row.*")
