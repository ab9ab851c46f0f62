"""Read pairs without bad tails and without adapters at their 3' side.

Adapters are looked up by the index of primers turned round: an adapter that the end of a read cuts short
is, read backwards, a primer that the start of a read cuts short. Reads pass in Arrow batches and are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyseq.operators.primer_index import MOST_BASES, Index, slices

#: Quality characters start here.
QUALITY_BASE = 33


def tail_sizes(quals: list[str], window: int, mean: float) -> np.ndarray:
    """Bases of each read up to the end of its last good window, from running sums over all reads together."""
    sizes = np.array([len(q) for q in quals], np.int64)
    told = np.zeros(len(quals), np.int32)
    scores = np.frombuffer("".join(quals).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) - QUALITY_BASE
    sums = np.concatenate([[0], np.cumsum(scores)])
    owner = np.repeat(np.arange(len(quals)), sizes)
    ends = np.arange(1, len(scores) + 1)
    place = ends - (np.cumsum(sizes) - sizes)[owner]
    size = np.minimum(sizes, window)[owner]
    good = np.flatnonzero(place >= size)
    good = good[sums[ends[good]] - sums[ends[good] - size[good]] >= mean * size[good]]
    told[owner[good]] = place[good]  # the last one of a read stays
    return told


def tail_length(qual: Column, window: int = 4, mean: float = 20.0) -> Column:
    """Bases up to the end of the last window whose mean quality reaches ``mean``; a read shorter than a window is one. Null counts as empty."""
    if window < 1:
        raise ValueError("a window has one base at least")

    @F.pandas_udf(IntegerType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for quals in batches:
            yield pd.Series(tail_sizes([q or "" for q in quals], window, mean))

    return run(qual)


def adapter_starts(rows: DataFrame, columns: dict[str, list[str]], rate: float = 0.1, min_overlap: int = 5) -> DataFrame:
    """Add ``<column>_end`` for each column of sequences: where its best adapter begins (from 0), else its length.

    ``columns`` maps a column to its adapters. Of an adapter at least ``min_overlap`` bases must stand in the read, at any place if it is whole, else at
    the end; ``floor(rate * overlap)`` edits are allowed. Most matched bases win, then fewest errors, then the place nearest to the end. Null sequences have length 0.
    """
    if sum(len(a) for adapters in columns.values() for a in adapters) > MOST_BASES:
        raise ValueError(f"adapters of more than {MOST_BASES} bases")
    names = rows.columns
    schema = StructType([*rows.schema.fields, *[StructField(f"{c}_end", IntegerType()) for c in columns]])

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = {c: Index([a.upper()[::-1] for a in sorted(adapters)], rate, min_overlap) for c, adapters in columns.items()}
        for c in columns:
            batches = slices(batches, names.index(c))
        for batch in batches:
            ends = []
            for c, index in indexes.items():
                reads = [(s or "").encode("ascii", "replace")[::-1] for s in batch.column(names.index(c)).to_pylist()]
                told = index.best(reads)
                ends.append(pa.array([len(s) - (t[2] + t[3] if t[0] >= 0 else 0) for s, t in zip(reads, told.tolist(), strict=True)], pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *ends], schema.names)

    return rows.mapInArrow(find, schema)


def trim_pairs(pairs: DataFrame, first: list[str], second: list[str], window: int = 4, mean: float = 20.0, rate: float = 0.1, min_overlap: int = 5) -> DataFrame:
    """Pairs (read_id, r1_seq, r1_qual, r2_seq, r2_qual) whose tails are cut and whose adapters, and what follows them, are gone. No pair is dropped."""
    cut = pairs.select("read_id", *[F.substr(c, F.lit(1), tail_length(F.col(f"r{k}_qual"), window, mean)).alias(c) for k in (1, 2) for c in (f"r{k}_seq", f"r{k}_qual")])
    found = adapter_starts(cut, {"r1_seq": first, "r2_seq": second}, rate, min_overlap)
    return found.select("read_id", *[F.substr(c, F.lit(1), F.col(f"r{k}_seq_end")).alias(c) for k in (1, 2) for c in (f"r{k}_seq", f"r{k}_qual")])
