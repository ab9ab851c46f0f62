"""Primers of a large panel found at the 5' side of reads, both mates, with errors and partial primers at the read's start.

The panel is small beside the reads: it is turned into an index of words, which every task builds from a panel of at most
``MOST_BASES`` bases. Reads pass once, in Arrow batches, and are not shuffled. A primer with ``e`` errors at most keeps two of ``e + 2``
pieces whole, and among those are two that differ in diagonal by no more than the pieces between them: each piece between has an error, and
were there more in every gap, they would be more than ``e``. So pairs of words of the reads that are such pairs of pieces give candidates (read, primer, diagonal);
a candidate is compared once, in a band of ``2 e + 1`` diagonals, all candidates of one primer length together. A primer without errors, or with fewer bases than
pieces, is looked up by one whole piece of ``e + 1``.

With two errors and four pieces a pair is looked at more closely before it becomes a candidate: a piece that stands at a found one on its outer or inner side
begins or ends where that does, and five bases of it tell at once whether it has no, one or more errors there. Each of the pieces that were not found has one error at most, or one of them has two
and three pieces are whole; then two of these have the third at their side. So a pair goes on if the errors told of its two neighbours are two at most, one that has no neighbour told counting as one.

A place is a window of the read within ``floor(rate * overlap)`` edits of the primer, or of a primer's end of at least ``min_overlap``
bases where the read starts inside the primer. The place with the most matched bases (overlap less errors) wins, then fewest
errors, the first start, the size closest to the overlap, the adapter's name, the smaller window. Defined results for odd
input: null and empty reads match nothing; bases are compared in upper case and others than A, C, G and T match
nothing; repeated reads are rows of their own; an empty panel or table gives ``no_adapter`` or nothing.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Bases of a panel, at most; more raise. The index takes some twenty bytes for each.
MOST_BASES = 20_000_000
#: Longest word of the index, where it is looked up in pairs and where alone.
WORD, LONE_WORD = 5, 9
#: Candidates that are compared together: their columns stay in a core's cache.
BAND_ROWS = 1 << 15
#: Bases of reads that are compared together, about.
TOGETHER = 1 << 20
FAR = 1 << 20
#: Bases of a neighbour that are looked at, and of the read beside it; numbers that stand for unknown bases, for no neighbour, and for bases beyond the read.
NEIGHBOUR, BESIDE = 5, 6
UNKNOWN, NONE, BEYOND = 4**NEIGHBOUR, 4**NEIGHBOUR + 1, 4**BESIDE
_MADE: dict = {}
CODES = np.full(256, 4, np.uint8)
for _code, _base in enumerate("ACGT"):
    CODES[[ord(_base), ord(_base.lower())]] = _code


def _neighbour_errors(backward: bool) -> np.ndarray:
    """Errors, 0, 1 or 2 for more, of each word of ``NEIGHBOUR`` bases in the ``BESIDE`` bases of a read of which it takes the first ones; ``backward``: the last ones."""
    digits = lambda n: np.stack(np.unravel_index(np.arange(4**n), (4,) * n), axis=1)[:, :: -1 if backward else 1].astype(np.int8)
    number = lambda bases: bases.astype(np.int64) @ 4 ** np.arange(bases.shape[1])
    words, beside = digits(NEIGHBOUR), digits(BESIDE)
    told = np.full((NONE + 1, BEYOND + 1), 2, np.uint8)
    own, there = number(words), [number(np.delete(beside, i, axis=1)) for i in range(BESIDE)]
    told[:UNKNOWN, :BEYOND][np.logical_or.reduce([own[:, None] == x[None, :] for x in there])] = 1  # the read has one more
    for i in range(NEIGHBOUR):
        without = number(np.delete(words, i, axis=1))
        told[:UNKNOWN, :BEYOND][without[:, None] == number(beside[:, : NEIGHBOUR - 1])[None, :]] = 1  # a base is missing
        told[:UNKNOWN, :BEYOND][without[:, None] == number(np.delete(beside[:, :NEIGHBOUR], i, axis=1))[None, :]] = 1
    told[:UNKNOWN, :BEYOND][own[:, None] == number(beside[:, :NEIGHBOUR])[None, :]] = 0
    told[UNKNOWN], told[:, BEYOND], told[NONE] = 0, 0, 1
    return told


def _neighbour(own: np.ndarray, i: int | None, piece: int, last: bool) -> np.ndarray:
    """For each primer the number of the first bases of its piece ``i`` or, with ``last``, of the last ones: a row of both tables of errors."""
    if i is None:
        return np.full(len(own), NONE)
    at = (i + 1) * piece - NEIGHBOUR if last else i * piece
    part = own[:, at : at + NEIGHBOUR].astype(np.int64)
    return np.where(part.max(axis=1) < 4, part @ 4 ** np.arange(NEIGHBOUR - 1, -1, -1), UNKNOWN) + last * (NONE + 1)


class Index:
    """Words of a panel's pieces, and the comparison of what they point at.

    An entry is a primer, or the end of one, which then must start with the read (``anchored``); ``rank`` is its primer's place in the panel.
    """

    def __init__(self, primers: list[str], rate: float, min_overlap: int):
        if any(not p for p in primers):
            raise ValueError("a primer is empty")
        whole = np.array([len(p) for p in primers], np.int64)
        ranks, ends, errors, anchored = [], [], [], []
        words: dict[tuple[int, int, int, bool, bool], list[list[np.ndarray]]] = {}
        narrow = lambda row: [x.astype(np.int32 if i < 3 else np.int16) for i, x in enumerate(row)]
        count = 0
        for n in np.unique(whole).tolist():
            rank = np.flatnonzero(whole == n)
            coded = CODES[np.frombuffer("".join(primers[i] for i in rank).encode("ascii", "replace"), np.uint8)].reshape(len(rank), n)
            for size in range(min(min_overlap, n), n + 1):
                e = math.floor(rate * size + 1e-9)
                if size < e + 1:
                    raise ValueError("the error rate leaves no piece of a primer whole")
                own, pieces = coded[:, n - size :], e + 2 if e and size >= e + 2 else e + 1
                piece = size // pieces
                word = min(piece, WORD if pieces > e + 1 else LONE_WORD)
                power = 4 ** np.arange(word - 1, -1, -1)
                parts = [own[:, i * piece : i * piece + word].astype(np.int64) for i in range(pieces)]
                clean = [part.max(axis=1) < 4 for part in parts]  # a piece with another letter is never whole
                for i in range(pieces):
                    if pieces == e + 1:
                        known = np.flatnonzero(clean[i])
                        words.setdefault((word, 0, 0, size < n, False), []).append(narrow([parts[i][known] @ power, count + known, np.full(len(known), i * piece)]))
                    for j in range(i + 1, pieces if pieces > e + 1 else 0):
                        known = np.flatnonzero(clean[i] & clean[j])
                        code = parts[i][known] @ power * 4**word + parts[j][known] @ power
                        row = [code, count + known, np.full(len(known), i * piece)]
                        told = e == 2 and word == NEIGHBOUR
                        if told:  # beside the first one piece 1 after piece 0, else the one before; beside the second the one after, or before piece 3 if that is not the first
                            before = None if (i, j) == (0, 1) else (1, False) if i == 0 else (i - 1, True)
                            behind = None if (i, j) == (2, 3) else (2, True) if j == 3 else (j + 1, False)
                            for side in (before, behind):
                                at, last = side or (None, False)
                                row += [_neighbour(own[known], at, piece, last), np.full(len(known), -BESIDE if last else piece)]
                        words.setdefault((word, (j - i) * piece, j - i - 1, size < n, told), []).append(narrow(row))
                ranks.append(rank)
                ends.append(own)
                errors.append(np.full(len(rank), e))
                anchored.append(np.full(len(rank), size < n))
                count += len(rank)
        #: For each kind of pair (bases of a word, distance, how much it may differ, at the read's start, neighbours told): the codes that occur, where each begins, entries, offsets, and both neighbours with their places.
        self.tables = {}
        self.told = np.concatenate([_neighbour_errors(False), _neighbour_errors(True)]).ravel() if any(kind[4] for kind in words) else None
        for kind in [*words]:
            size, apart = kind[:2]
            code, number, offset, *beside = (np.concatenate(x) for x in zip(*words.pop(kind), strict=True))
            order = np.argsort(code, kind="stable")
            many = np.bincount(code, minlength=4 ** (2 * size if apart else size))
            starts = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
            self.tables[kind] = (many > 0, starts, number[order], offset[order], [x[order] for x in beside])
        every = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        self.length = np.repeat([x.shape[1] for x in ends], [len(x) for x in ends]).astype(np.int64)
        self.error, self.anchored, self.rank = every(errors, np.int64), every(anchored, bool), every(ranks, np.int64)
        self.bases = np.full((count, max(self.length, default=1)), 5, np.uint8)
        at = 0
        for own in ends:
            self.bases[at : at + len(own), : own.shape[1]] = np.where(own < 4, own, 5)  # 5 equals no base of a read
            at += len(own)
        #: For each base the places of a primer that hold it, as bits.
        bits = np.uint64(1) << np.arange(min(self.bases.shape[1], 64), dtype=np.uint64)
        self.holds = np.stack([((self.bases[:, : len(bits)] == b) * bits).sum(axis=1, dtype=np.uint64) for b in range(5)], axis=1)

    def candidates(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (read, entry, diagonal) at which the first of two pieces stands whole."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        rest = sizes[owner] - place
        found = []
        near_start = int(self.length.max() + self.error.max())
        others = np.concatenate([[0], np.cumsum(codes > 3)])
        values = [np.zeros(len(codes), np.int64)]  # by length, the words that begin at each place
        beside = np.full(len(codes) + 1, BEYOND, np.int64)  # the bases that begin at each place, as a number
        if self.told is not None and len(codes) >= BESIDE:
            ends = len(codes) - BESIDE + 1
            number = sum(codes[i : ends + i].astype(np.int64) * 4 ** (BESIDE - 1 - i) for i in range(BESIDE))
            beside[:ends] = np.where((rest[:ends] >= BESIDE) & (others[BESIDE:] == others[:ends]), number, BEYOND)
        for (size, apart, slack, anchored, told), (present, begins, number, offset, neighbours) in self.tables.items():
            if len(codes) < size:
                continue
            while len(values) <= size:
                long = len(values)
                values.append(values[-1][: len(codes) - long + 1] * 4 + (codes[long - 1 :] & 3))
            value = values[size]
            inside = (rest[: len(value)] >= size) & (others[size:] == others[: len(value)])
            first = inside & (place[: len(value)] < near_start) if anchored else inside
            for far in range(apart - slack, apart + slack + 1):
                if len(value) <= far:
                    break
                at = np.flatnonzero(first[: len(value) - far] & inside[far:] & (rest[: len(value) - far] >= far + size))
                code = value[at] * 4**size + value[at + far] if apart else value[at]
                met = present[code]
                at, code = at[met], code[met]
                low, many = begins[code].astype(np.int64), begins[code + 1] - begins[code]
                row = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                at = np.repeat(at, many)
                entry, diagonal = number[row], place[at] - offset[row]
                error = self.error[entry]
                near = np.abs(diagonal) <= error if anchored else diagonal >= -error
                near = np.flatnonzero(near)
                if told:
                    errors = np.zeros(len(near), np.uint8)
                    for code, shift, first_at in ((*neighbours[:2], 0), (*neighbours[2:], far)):
                        shift = first_at + shift[row[near]]
                        own = at[near]
                        there = np.where((place[own] + shift >= 0) & (rest[own] >= shift + BESIDE), own + shift, len(codes))
                        errors += self.told[code[row[near]].astype(np.int64) * (BEYOND + 1) + beside[there]]
                    near = near[errors <= 2]
                found.append(np.stack([owner[at[near]], entry[near], diagonal[near]]))
        if not found:
            return (np.empty(0, np.int64),) * 3
        read, entry, diagonal = np.concatenate(found, axis=1)
        key = np.sort((read * len(self.rank) + entry) * (2 * FAR) + diagonal + FAR)
        key = key[np.append(True, key[1:] != key[:-1])[: len(key)]]
        pair, diagonal = np.divmod(key, 2 * FAR)
        return pair // len(self.rank), pair % len(self.rank), diagonal - FAR

    def _within(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, read: np.ndarray, entry: np.ndarray, first: np.ndarray, n: int, e: int) -> np.ndarray:
        """Which candidates have some window of the band within ``e`` edits: columns of the edit table as bits, a word for each candidate."""
        one, top = np.uint64(1), np.uint64(n - 1)
        up, down = np.full(len(read), np.uint64(2**64 - 1)), np.zeros(len(read), np.uint64)
        score, least = np.full(len(read), n, np.int64), np.full(len(read), n, np.int64)
        padded = np.append(codes, np.uint8(4))
        for k in range(n + 2 * e):
            at = first + k
            base = padded[np.where((at >= 0) & (at < sizes[read]), at + starts[read], len(codes))]
            same = self.holds[entry, base]
            diagonal = (((same & up) + up) ^ up) | same
            right, left = down | ~(diagonal | up), up & diagonal
            score += ((right >> top) & one).astype(np.int64) - ((left >> top) & one).astype(np.int64)
            right, left = right << one, left << one
            up, down = left | ~((same | down) | right), right & (same | down)
            np.minimum(least, score, out=least)
        return least <= e

    def compare(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, read: np.ndarray, entry: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Rows (read, entry, errors, start, size) of the candidates within their errors: the best place of each."""
        out = [np.empty((0, 5), np.int64)]
        kind = self.length[entry] * 64 + self.error[entry]
        groups = [np.flatnonzero(kind == k) for k in np.unique(kind)]
        for some in (g[at : at + BAND_ROWS] for g in groups for at in range(0, len(g), BAND_ROWS)):
            k = kind[some[0]]
            n, e = int(k // 64), int(k % 64)
            r, a = read[some], entry[some]
            first = diagonal[some] - e  # the read place that faces the primer's first base on the lowest diagonal
            if n <= 64:
                near = self._within(codes, starts, sizes, r, a, first, n, e)
                r, a, first = r[near], a[near], first[near]
            width = 2 * e + 1
            # an element is errors * FAR + start; starts before the read, or not at it for anchored ends, are out of reach
            begins = first[:, None] + np.arange(width)
            out_of_reach = FAR * FAR
            value = np.where((begins >= 0) & (~self.anchored[a][:, None] | (begins == 0)), begins, out_of_reach)
            for b in range(1, width):
                value[:, b] = np.minimum(value[:, b], out_of_reach)
            padded = np.append(codes, np.uint8(4))
            for i in range(n):
                at = first[:, None] + i + np.arange(width)
                held = (at >= 0) & (at < sizes[r][:, None])
                base = padded[np.where(held, at + starts[r][:, None], len(codes))]
                step = np.where(held, value + (base != self.bases[a, i][:, None]) * FAR, out_of_reach)
                step[:, :-1] = np.minimum(step[:, :-1], value[:, 1:] + FAR)  # a base of the primer is missing
                for b in range(1, width):  # the read has one more
                    step[:, b] = np.minimum(step[:, b], np.where(held[:, b], step[:, b - 1] + FAR, out_of_reach))
                value = step
            errors, start = np.divmod(value, FAR)
            ends = first[:, None] + n + np.arange(width)
            size = ends - start
            good = (errors <= e) & (ends <= sizes[r][:, None])
            rank = np.where(good, (errors * FAR + start) * 256 + np.abs(size - n) * 2 + (size > n), np.iinfo(np.int64).max)
            best = rank.argmin(axis=1)
            rows = np.arange(len(r))
            ok = good[rows, best]
            out.append(np.stack([r, a, errors[rows, best], start[rows, best], size[rows, best]], axis=1)[ok])
        return np.concatenate(out)

    def best(self, reads: list[bytes]) -> np.ndarray:
        """Per read (entry or -1, errors, start, size)."""
        sizes = np.array([len(x) for x in reads], np.int64)
        told = np.full((len(reads), 4), -1, np.int64)
        if not len(self.rank) or not sizes.sum():
            return told
        codes, starts = CODES[np.frombuffer(b"".join(reads), np.uint8)], np.cumsum(sizes) - sizes
        rows = self.compare(codes, starts, sizes, *self.candidates(codes, starts, sizes))
        read, entry, errors, start, size = rows.T
        overlap = self.length[entry]
        order = np.lexsort((size, self.rank[entry], np.abs(size - overlap), start, errors, errors - overlap, read))
        first = order[np.unique(read[order], return_index=True)[1]]
        told[read[first]] = rows[first, 1:]
        return told


def _indexes(name: str, panels: list, rate: float, min_overlap: int) -> list:
    """Names and index of each panel; a worker keeps those of the last call, so that its next task need not make them again."""
    if name not in _MADE:
        _MADE.clear()
        _MADE[name] = [(names, Index(primers, rate, min_overlap)) for names, primers in panels]
    return _MADE[name]


def slices(batches: Iterable[pa.RecordBatch], first: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of the column ``first`` have about ``TOGETHER`` letters, one row at least."""
    for whole in batches:
        if not whole.num_rows:
            continue
        lengths = np.cumsum(pc.fill_null(pc.binary_length(whole.column(first)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [0, *np.flatnonzero(np.diff(lengths // TOGETHER)) + 1, whole.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            yield whole.slice(low, high - low)


def _panel(panel: DataFrame) -> tuple[list[str], list[str]]:
    """Adapters and primers by name; the panel's size is checked before it is fetched."""
    named = panel.select("adapter", F.upper("primer").alias("primer")).where("primer <> ''")
    bases = named.agg(F.sum(F.length("primer"))).first()[0] or 0
    if bases > MOST_BASES:
        raise ValueError(f"a panel of more than {MOST_BASES} bases")
    rows = sorted((r.adapter, r.primer) for r in named.collect())
    return [r[0] for r in rows], [r[1] for r in rows]


def assign_pairs(pairs: DataFrame, forward: DataFrame, reverse: DataFrame, error_rate: float = 0.1, min_overlap: int = 20) -> DataFrame:
    """Adapters of both mates: read_id, and for each mate adapter, match, start (from 0) and errors; ``no_adapter`` for none.

    ``pairs`` has read_id, r1_seq, r2_seq; ``forward`` and ``reverse`` are panels (adapter, primer) of the first and second mate.
    """
    sent = pairs.sparkSession.sparkContext.broadcast([_panel(forward), _panel(reverse)])
    fields = [pairs.schema["read_id"]]
    for mate in (1, 2):
        fields += [StructField(f"adapter{mate}", StringType()), StructField(f"match{mate}", StringType()), StructField(f"start{mate}", IntegerType()), StructField(f"errors{mate}", IntegerType())]
    name = uuid.uuid4().hex

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _indexes(name, sent.value, error_rate, min_overlap)
        for batch in slices(batches, 1):
            columns = [batch.column(0)]
            for (names, index), seqs in zip(kept, batch.columns[1:], strict=True):
                reads = [(s or "").encode("ascii", "replace") for s in seqs.to_pylist()]
                told = index.best(reads)
                got = told[:, 0] >= 0
                columns += [
                    pa.array([names[index.rank[t[0]]] if t[0] >= 0 else "no_adapter" for t in told], pa.string()),
                    pa.array([s[t[2] : t[2] + t[3]].decode().upper() if t[0] >= 0 else "" for s, t in zip(reads, told, strict=True)], pa.string()),
                    pa.array(told[:, 2].astype(np.int32), mask=~got),
                    pa.array(told[:, 1].astype(np.int32), mask=~got),
                ]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return pairs.select("read_id", "r1_seq", "r2_seq").mapInArrow(find, StructType(fields))
