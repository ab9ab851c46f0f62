"""Primers found in reads, with errors.

The panel is small beside the reads: each task builds an index of its pieces, and reads pass once, in Arrow batches. They
are neither joined nor shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyseq.operators.primer_index import MOST_BASES, slices

#: Different lengths of primers; more raise.
MOST_LENGTHS = 1000
#: Words of an index that are looked up in a plain table, at most.
PLAIN = 1 << 22


class Pieces:
    """Pieces of a panel's primers, and the windows of reads that hold one whole.

    Letters are compared as they are: those that no primer has share the code 0, which no primer has.
    """

    def __init__(self, primers: list[str], rate: float, indels: bool):
        self.indels = indels
        letters = sorted(set("".join(primers)))
        self.base = len(letters) + 1
        self.codes = np.zeros(0x110000, np.uint16)
        self.codes[[ord(c) for c in letters]] = np.arange(1, self.base)
        self.length = np.array([len(p) for p in primers], np.int64)
        self.error = np.array([math.floor(rate * n + 1e-9) for n in self.length], np.int64)
        self.bases = np.zeros((len(primers), max(self.length, default=1)), np.uint16)
        most = int(63 / math.log2(self.base)) if primers else 1
        words: dict[int, list[tuple[int, int, int]]] = {}
        for number, primer in enumerate(primers):
            own = self.codes[[ord(c) for c in primer]]
            self.bases[number, : len(own)] = own
            piece = len(own) // (int(self.error[number]) + 1)
            for i in range(int(self.error[number]) + 1):
                word = 0
                for c in own[i * piece : i * piece + min(piece, most)].tolist():
                    word = word * self.base + c
                words.setdefault(min(piece, most), []).append((word, number, i * piece))
        self.tables = {}
        for size, rows in words.items():
            word, number, offset = np.array(sorted(rows), np.int64).T
            known, begins = np.unique(word, return_index=True)
            table = None
            if self.base**size <= PLAIN:
                table = np.full(self.base**size, -1, np.int64)
                table[known] = np.arange(len(known))
            self.tables[size] = (known, table, np.append(begins, len(word)), number, offset)

    def _candidates(self, codes: np.ndarray, owner: np.ndarray, place: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct (read, primer, start) of windows that may hold a primer, as a piece of it stands whole near."""
        found = [np.empty((3, 0), np.int64)]
        for size, (known, table, begins, number, offset) in self.tables.items():
            if len(codes) < size:
                continue
            word = codes[: len(codes) - size + 1].astype(np.int64)
            for j in range(1, size):
                word = word * self.base + codes[j : len(codes) - size + 1 + j]
            rank = table[word] if table is not None else np.searchsorted(known, word)
            hit = rank >= 0 if table is not None else known[np.minimum(rank, len(known) - 1)] == word
            at = np.flatnonzero(hit & (place[: len(word)] + size <= sizes[owner[: len(word)]]))
            low = begins[rank[at]]
            many = begins[rank[at] + 1] - low
            row = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            at = np.repeat(at, many)
            found.append(np.stack([owner[at], number[row], place[at] - offset[row]]))
        read, primer, diagonal = np.concatenate(found, axis=1)
        e = self.error[primer]
        row = np.repeat(np.arange(len(e)), 2 * e + 1)
        read, primer, start = read[row], primer[row], diagonal[row] + np.arange(len(row)) - np.repeat(np.cumsum(2 * e + 1) - e - 1, 2 * e + 1)
        slack = self.error[primer] if self.indels else 0
        held = (start >= 0) & (start + self.length[primer] - slack <= sizes[read])
        span = int(sizes.max()) + 1
        key = np.unique((read[held] * len(self.length) + primer[held]) * span + start[held])
        pair, start = np.divmod(key, span)
        return pair // len(self.length), pair % len(self.length), start

    def best(self, reads: list[str]) -> np.ndarray:
        """Per read (primer or -1, errors, start, size) of its best place."""
        told = np.full((len(reads), 4), -1, np.int64)
        sizes = np.array([len(x) for x in reads], np.int64)
        if not len(self.length) or not sizes.sum():
            return told
        codes = self.codes[np.frombuffer("".join(reads).encode("utf-32-le", "surrogatepass"), np.uint32)]
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)
        every = self._candidates(codes, owner, np.arange(len(codes)) - starts[owner], sizes)
        found = [np.empty((0, 5), np.int64)]
        for e in np.unique(self.error[every[1]]):
            for n in np.unique(self.length[every[1]][self.error[every[1]] == e]):
                some = (self.error[every[1]] == e) & (self.length[every[1]] == n)
                found.append(self._compare(codes, starts, sizes, *(x[some] for x in every), int(n), int(e)))
        read, primer, errors, start, size = rows = np.concatenate(found).T
        order = np.lexsort((size, primer, np.abs(size - self.length[primer]), start, errors, read))
        first = order[np.unique(read[order], return_index=True)[1]]
        told[read[first]] = rows[1:, first].T
        return told

    def _compare(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, read: np.ndarray, primer: np.ndarray, start: np.ndarray, n: int, e: int) -> np.ndarray:
        """Rows (read, primer, errors, start, size) of the windows within ``e`` edits; edits are counted in a band along the window's diagonal."""
        width = e if self.indels else e // 2
        far = n + e + 1
        value = np.full((2 * width + 1, len(read)), far, np.int16)
        value[width:] = np.arange(width + 1)[:, None]
        origin = starts[read] + start
        for i in range(n):
            wanted = self.bases[primer, i]
            for b in range(2 * width + 1):
                at = i + b - width
                step = value[b] + (codes[np.minimum(origin + at, len(codes) - 1)] != wanted) if at >= 0 else np.full(len(read), far, np.int16)
                if b < 2 * width:
                    step = np.minimum(step, value[b + 1] + 1)  # a base of the primer is missing
                if b:
                    step = np.minimum(step, value[b - 1] + 1)  # the read has one more
                value[b] = step
        out = []
        for b in range(2 * width + 1) if self.indels else [width]:
            size = n + b - width
            good = np.flatnonzero((value[b] <= e) & (start + size <= sizes[read]))
            out.append(np.stack([read[good], primer[good], value[b][good].astype(np.int64), start[good], np.full(len(good), size, np.int64)], axis=1))
        return np.concatenate(out)


def assign_primers(reads: DataFrame, panel: DataFrame, error_rate: float = 0.1, indels: bool = True) -> DataFrame:
    """Per read the best place of a primer: read_id, adapter, match, start (from 0), errors; ``no_adapter`` for none.

    ``reads`` has read_id, seq, ``panel`` has adapter, primer, of ``MOST_BASES`` bases at most. A place is a window within
    ``e`` = floor(rate * length) edits, of ``e`` bases less to ``e`` more than the primer; without ``indels`` of the
    primer's length alone. Of ``e + 1`` pieces of a primer one is whole in such a window, moved by ``e`` at most, so
    words of the reads are looked up among the pieces and only then edits are counted. Fewest errors win, then the first
    start, then the length closest to the primer's, then the adapter's name, then the shorter window.
    """
    named = panel.select("adapter", F.upper("primer").alias("primer")).where("primer <> ''")
    lengths = sorted(r[0] for r in named.select(F.length("primer")).distinct().limit(MOST_LENGTHS + 1).collect())
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"primers of more than {MOST_LENGTHS} different lengths")
    if any(n // (math.floor(error_rate * n + 1e-9) + 1) < 1 for n in lengths):
        raise ValueError("the error rate leaves no piece of a primer whole")
    if (named.agg(F.sum(F.length("primer"))).first()[0] or 0) > MOST_BASES:
        raise ValueError(f"a panel of more than {MOST_BASES} bases")
    rows = sorted(((r.adapter, r.primer) for r in named.collect()), key=lambda r: (r[0] is not None, r))
    sent = reads.sparkSession.sparkContext.broadcast(rows)
    schema = StructType([reads.schema["read_id"], StructField("adapter", StringType()), StructField("match", StringType()), StructField("start", IntegerType()), StructField("errors", IntegerType())])

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [r[0] for r in sent.value]
        pieces = Pieces([r[1] for r in sent.value], error_rate, indels)
        for batch in slices(batches, 1):
            seqs = [s or "" for s in batch.column(1).to_pylist()]
            told = pieces.best(seqs)
            none = told[:, 0] < 0
            places = told.tolist()
            columns = [
                pa.array(["no_adapter" if t[0] < 0 or names[t[0]] is None else names[t[0]] for t in places], pa.string()),
                pa.array(["" if t[0] < 0 else s[t[2] : t[2] + t[3]] for s, t in zip(seqs, places, strict=True)], pa.string()),
                pa.array(told[:, 2].astype(np.int32), mask=none),
                pa.array(told[:, 1].astype(np.int32), mask=none),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return reads.select("read_id", F.upper("seq").alias("seq")).mapInArrow(find, schema)
