"""Dropping rows that a near-duplicate operator decided against, without shuffling the texts of the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Decisions up to this number are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def keep_decided(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and text are a keeper's; of equal ids and texts one. All columns stay as they are.

    ``decided`` has ``__id``, ``__key`` (``text_key``) and ``__keeper`` for each row of ``docs``. Only the rows that go,
    and those that stand more than once, are joined; where they are few they are broadcast and no text moves.
    """
    pairs = decided.groupBy("__id", "__key").agg(F.bool_or("__keeper").alias("keeper"), F.count("*").alias("rows"))
    touched = pairs.where("not keeper or rows > 1")
    n = touched.count()
    if not n:
        return docs
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col(id_col).alias("__own_id"), text_key(F.col(text_col)).alias("__own_key"))
    small = F.broadcast(touched) if n <= BROADCAST_ROWS else touched
    same = packed["__own_id"].eqNullSafe(small["__id"]) & (packed["__own_key"] == small["__key"])
    alone = packed.join(small, same, "left_anti").select("__row.*")
    repeated = touched.where("keeper")
    if not repeated.limit(1).count():
        return alone
    repeated = F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated
    same = packed["__own_id"].eqNullSafe(repeated["__id"]) & (packed["__own_key"] == repeated["__key"])
    one = packed.join(repeated.select("__id", "__key"), same, "left_semi").dropDuplicates(["__own_id", "__own_key"])
    return alone.union(one.select("__row.*"))
