"""Counting while groups of reads arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyseq.functions.sequence import features_of
from tallyseq.operators.counts import assigned


def stream_molecule_counts(groups: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Running molecules per sample and feature (output mode update or complete).

    A molecule counts once as long as its repeats come within ``delay`` of one another in event
    time; the state that knows it goes with the watermark, so it does not grow with the stream.
    """
    known = assigned(groups).withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["sample", "gene", "final_umi"])
    return known.groupBy("sample", features_of(F.col("gene")).alias("feature")).agg(F.count("*").alias("n"))
