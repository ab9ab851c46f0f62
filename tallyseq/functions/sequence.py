"""Sequence functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """Case is kept; other letters stay as they are."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def gc_count(seq: Column) -> Column:
    return F.length(seq) - F.length(F.translate(seq, "GC", ""))


def pairing_score(seq: Column) -> Column:
    """2 to the power of length plus GC count."""
    return F.pow(F.lit(2.0), F.length(seq) + gc_count(seq))


def kmers(seq: Column, k: int) -> Column:
    """Structs (at, kmer) of all windows of ``k`` bases, from 0; none for a shorter sequence."""
    every = lambda s: F.transform(F.sequence(F.lit(0), F.length(s) - k), lambda i: F.struct(i.alias("at"), F.substr(s, i + 1, F.lit(k)).alias("kmer")))
    return _once(seq, lambda s: F.when(F.length(s) >= k, every(s)).otherwise(F.array().cast("array<struct<at:int,kmer:string>>")))


def _once(seq: Column, every: Callable[[Column], Column]) -> Column:
    """An array made of ``seq``, which an outer lambda holds: an expression inside a lambda is computed again for each element."""
    return F.flatten(F.transform(F.array(seq), every))


def tails(seq: Column, k_min: int, k_max: int, most_from_end: int) -> Column:
    """Structs (tail, d): windows of each length that end ``d`` bases before the 3' end."""
    one = lambda s, k: F.transform(F.sequence(F.lit(0), F.lit(most_from_end)), lambda d: F.struct(F.substr(s, F.length(s) - d - k + 1, F.lit(k)).alias("tail"), d.alias("d")))
    every = lambda s: F.filter(F.flatten(F.array(*[one(s, k) for k in range(k_min, k_max + 1)])), lambda x: F.length(x["tail"]) + x["d"] <= F.length(s))
    return _once(seq, every)


def features_of(gene: Column) -> Column:
    """Genes of a composite name without its primer pair, joined by a bar."""
    parts = F.split(gene, ",")
    return F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "|")).otherwise("")
