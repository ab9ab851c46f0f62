"""Numbers of rows in a global order, without one task that sorts them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.session import materialize

#: The low bits of a row number within its partition.
IN_PARTITION = (1 << 33) - 1


def global_rank(rows: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Add the row's number (from 0) in ``order``: ranges are sorted by their own tasks, offsets come from their sizes."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumns({"__at": F.monotonically_increasing_id().bitwiseAND(IN_PARTITION), "__range": F.spark_partition_id()}))
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__range", F.coalesce(before, F.lit(0)).alias("__before"))  # one row per partition
    return placed.join(F.broadcast(offsets), "__range").withColumn(name, F.col("__before") + F.col("__at")).drop("__at", "__range", "__before")
