"""Best-fit packing: a configuration linear program over the length histogram.

Only a histogram of lengths, at most one row per length, reaches the driver. A configuration is a multiset
of lengths that fits a sequence. Multiplicative weights look for the prices of the configuration program: they start
from the lengths themselves, each round the best configurations under the prices are found by knapsack dynamic
programming, and the price of what they cover too often falls. The best prices seen also bound the number
of sequences from below. Rounding makes whole sequences: the longest piece that is left opens one, the dynamic program over
what is left completes it, and the sequence is repeated as often as the pieces allow. The shortest
pieces may wait, a small share of all tokens, until the same program puts them into the gaps. No piece is placed by another rule.
Where sequences can be filled to the brim the lengths are themselves the best prices, and the rounds find no higher bound; where
they cannot, say with pieces of a third to a half of a sequence, the weights move.
Sequences are kept as groups of equal content, so that the work does not grow with their number. Pieces
then find their places by their length and their rank among pieces of that length.

Defined results for odd input: a null text is empty and gives one piece with the end token; a text of any length is
cut into pieces, whole; rows that repeat an id are packed each; ids have any type and a null id is packed like any other;
pieces of equal length take places in order of their rows; other columns are ignored, and an id column that is named like an
added one comes out as name + ``_input``; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyseq.llm.names import clear_of
from tallyseq.session import materialize

CAPACITY = 4096
END_ID = 1
#: Price classes and rounds of the weights.
CLASSES = 128
ROUNDS = 150
#: Share of the tokens, in the shortest pieces, that may wait for gaps.
FILLER = 0.06
#: Bytes that a worker remembers of chunks of text and their ids before it begins anew, and the longest chunk that it remembers.
MEMO_BYTES = 1 << 27
LONG_CHUNK = 64
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters below this code point have one lower-case form, wherever they stand.
LATIN_END = "\u0250"
#: Runs of letters on which two ways of encoding are compared.
PROBES = ("a", "the", "tokenization", "überfüßig", "ñandúes", "œuvre", "łódź", "þorn", "ÿ", "straße", "naïveté", "zzyzxq")
#: Pieces of a partition that share a rank bucket.
BUCKET = 1 << 16

#: Columns of the result beside the id.
ADDED = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")

_encoders: dict[str, ChunkEncoder] = {}


class Memo(dict):
    """Ids of chunks, made by ``make`` when first asked for; ``held`` is about the bytes that they take."""

    def __init__(self, make=None):
        super().__init__({"": b""})
        self.make, self.held = make, 0

    def __setitem__(self, chunk: str, ids: bytes) -> None:
        super().__setitem__(chunk, ids)
        self.held += 4 * len(chunk) + len(ids) + 160

    def __missing__(self, chunk: str) -> bytes:
        ids = self.make(chunk)
        if len(chunk) <= LONG_CHUNK:
            self[chunk] = ids
        return ids


class ChunkEncoder:
    """Ids of whole texts as little-endian bytes, for a tokenizer whose words never span white space.

    A text is cut at spaces and line feeds, which that tokenizer drops, and a chunk that was
    met before is looked up. A new chunk of Latin letters, perhaps with ASCII punctuation
    behind, is put together from its lower-case letters and its punctuation, as the tokenizer
    splits it. New runs of letters go to the vocabulary's merges directly where that gives what the tokenizer gives
    for a few probes; else they are encoded many at once and told apart by their last tokens,
    which alone carry the end-of-word mark. Any other chunk is encoded by itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix") or ""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends_word[number] = bool(mark) and token.endswith(mark)
        self.marked = bool(mark)
        # letters as the byte-level alphabet writes them: printable bytes stand for themselves, others for code points from 256 on
        hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
        self.alphabet = {b: 256 + n for n, b in enumerate(hidden)}
        self.direct = all(self._merged(w) == np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in PROBES)
        self.memo = self._fresh_memo()

    def _fresh_memo(self) -> Memo:
        return Memo(self._make if self.direct else None)

    @classmethod
    def of(cls, path: str) -> ChunkEncoder:
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def _one_by_one(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), 4096):
            some = chunks[at : at + 4096]
            for chunk, got in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
                self.memo[chunk] = np.array(got.ids, "<u4").tobytes()

    def _merged(self, run: str) -> bytes:
        word = run if run.isascii() else run.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [token.id for token in self.tokenizer.model.tokenize(word)]).tobytes()

    def _make(self, chunk: str) -> bytes:
        """The ids of one chunk; its letters and its punctuation are remembered, too."""
        run = chunk.rstrip(PUNCTUATION)
        low = run.lower()
        if low and low.isalpha() and (run.isascii() or (max(run) < LATIN_END and "\u0130" not in run)):
            tail = chunk[len(run) :]
            if low == chunk:
                return self._merged(low)
            return self.memo[low] + self.memo[tail] if tail else self.memo[low]
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _letters(self, runs: list[str]) -> None:
        for at in range(0, len(runs), 4096):
            some = runs[at : at + 4096]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            if len(ends) != len(some):  # not one word to a run
                self._one_by_one(some)
                continue
            data, start = ids.tobytes(), 0
            for run, end in zip(some, ends.tolist(), strict=True):
                self.memo[run] = data[start:end]
                start = end

    def _learn(self, fresh: list[str]) -> None:
        memo, letters, others, joined = self.memo, set(), set(), []
        for chunk in fresh:
            run = chunk.rstrip(PUNCTUATION)
            low = run.lower()
            if self.marked and low and low.isalpha() and max(run) < LATIN_END and "\u0130" not in run:
                tail = chunk[len(run) :]
                joined.append((chunk, low, tail))
                if low not in memo:
                    letters.add(low)
                if tail not in memo:
                    others.add(tail)
            else:
                others.add(chunk)
        self._letters([*letters])
        self._one_by_one([*others])
        for chunk, low, tail in joined:
            memo[chunk] = memo[low] + memo[tail]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if self.memo.held > MEMO_BYTES:
            self.memo = self._fresh_memo()
        cut = [text.replace("\n", " ").split(" ") for text in texts]
        memo = self.memo
        if self.direct:
            return [b"".join(map(memo.__getitem__, chunks)) for chunks in cut]
        if fresh := list({c for chunks in cut for c in chunks if c not in memo}):
            self._learn(fresh)
        return [b"".join(map(memo.__getitem__, chunks)) for chunks in cut]


def _in_steps(encoder: ChunkEncoder, texts: list[str], chars: int = 2_000_000) -> Iterator[bytes]:
    """Encode texts a few at a time: as many as hold ``chars`` characters together, one at least."""
    some, held = [], 0
    for text in texts:
        if some and held + len(text) > chars:
            yield from encoder.encode_all(some)
            some, held = [], 0
        some.append(text)
        held += len(text)
    yield from encoder.encode_all(some) if some else ()


def _cut(path: str, capacity: int, end_id: int, whole_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part, seen = ChunkEncoder.of(path), TaskContext.get().partitionId(), 0
        for rows in batches:
            out: list[tuple] = []
            texts = [t or "" for t in rows["text"]]
            for id_, ids in zip(rows["id"], _in_steps(encoder, texts), strict=True):
                ids += end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - start)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    out.append((id_, piece, start, length, crc, (part << 32) + seen // BUCKET, seen))
                    seen += 1
            made = pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids_crc32", "bucket", "at"])
            yield made.astype({"id": "Int64"}) if whole_ids else made

    return run


# ---- the plan: on the driver, over a histogram of at most `capacity` rows ----

Group = tuple[int, tuple[tuple[int, int], ...]]


def best_values(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack dynamic program: the highest price of pieces that fit each room up to ``capacity``; ``sizes`` ascend."""
    best = np.zeros(capacity + 1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(int(sizes[0]), capacity + 1):
        k = fits[room]
        best[room] = max(best[room - 1], (best[room - sizes[:k]] + prices[:k]).max())
    return best


def best_filling(best: np.ndarray, prices: np.ndarray, sizes: np.ndarray, room: int, left: np.ndarray | None = None) -> tuple[dict[int, int], int]:
    """The filling that the dynamic program finds for a room, from what is left, and the room that stays; of equals the largest piece first."""
    chosen: dict[int, int] = defaultdict(int)
    left = None if left is None else left.copy()
    while k := int(np.searchsorted(sizes, room, side="right")):
        value = best[room - sizes[:k]] + prices[:k]
        if left is not None:
            value = np.where(left[:k] > 0, value, -1.0)
        i = k - 1 - int(value[::-1].argmax())
        if value[i] <= 0:
            break
        chosen[i] += 1
        room -= int(sizes[i])
        if left is not None:
            left[i] -= 1
    return chosen, room


def size_classes(lengths: np.ndarray, counts: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class of each length, of about equal token mass, its longest length and its pieces."""
    mass = np.cumsum(lengths * counts) / (lengths * counts).sum()
    of = np.unique(np.minimum((mass * classes).astype(int), classes - 1), return_inverse=True)[1]
    return of, np.array([lengths[of == g].max() for g in range(of.max() + 1)]), np.bincount(of, weights=counts)


def weighted_prices(lengths: np.ndarray, counts: np.ndarray, capacity: int, classes: int = CLASSES, rounds: int = ROUNDS, step: float = 0.15, slack: float = 0.03) -> np.ndarray:
    """Prices of the lengths by multiplicative weights; no configuration of size classes costs more than 1.

    A round takes, for each class, the best configuration that holds it, if its price is within ``slack`` of the best of all.
    Of the prices of all rounds and their average those of the highest bound are returned, in a class in proportion to the lengths.
    """
    of, sizes, demand = size_classes(lengths, counts, classes)
    prices, average, top, found = sizes / capacity, np.zeros(len(sizes)), 0.0, sizes / capacity
    for turn in range(rounds):
        best = best_values(prices, sizes, capacity)
        prices, best = prices / best[-1], best / best[-1]
        bound = float((demand * prices).sum())
        if bound > top:
            top, found = bound, prices.copy()
        average += (turn + 1) * prices
        value = prices + best[capacity - sizes]
        cover, dealt = np.zeros(len(sizes)), 0.0
        for k in np.flatnonzero(value >= 1 - slack):
            chosen, _ = best_filling(best, prices, sizes, capacity - int(sizes[k]))
            chosen[int(k)] += 1
            times = demand[k] / chosen[int(k)] * np.exp(-2 * (1 - value[k]) / slack)
            dealt += times
            for i, a in chosen.items():
                cover[i] += times * a
        over = cover * bound / dealt / demand - 1
        prices = prices * np.exp(-step / np.sqrt(1 + turn / 12) * np.clip(over, -1, 1.5))
    average /= best_values(average, sizes, capacity)[-1]
    chosen = average if float((demand * average).sum()) > top else found
    return (chosen / sizes)[of] * lengths


def rounded(lengths: np.ndarray, counts: np.ndarray, prices: np.ndarray, capacity: int, waiting: float) -> list[Group]:
    """Whole sequences for all pieces; the shortest, up to a share ``waiting`` of the tokens, go into gaps."""
    small = (np.cumsum(lengths * counts) <= waiting * (lengths * counts).sum()) & (lengths <= capacity // 4)
    left = counts.copy()
    groups: list[tuple[int, int, tuple[tuple[int, int], ...]]] = []

    def open_sequences(which: np.ndarray) -> None:
        while len(live := np.flatnonzero((left > 0) & which)):
            sizes, own, rest = lengths[live], prices[live], left[live]
            best = best_values(own, sizes, capacity)
            turns = max(1, len(live) // 6)  # then the program is solved anew, over what is left by then
            for i in range(len(live) - 1, -1, -1):
                while rest[i] > 0 and turns:
                    rest[i] -= 1
                    chosen, gap = best_filling(best, own, sizes, capacity - int(sizes[i]), rest)
                    rest[i] += 1
                    chosen[i] += 1
                    times = min(int(rest[k]) // a for k, a in chosen.items())
                    for k, a in chosen.items():
                        rest[k] -= times * a
                    groups.append((times, gap, tuple((int(sizes[k]), a) for k, a in chosen.items())))
                    turns -= 1
            left[live] = rest

    open_sequences(~small)
    todo, groups[:] = sorted(groups, key=lambda g: g[1]), []
    live, best, age = np.flatnonzero((left > 0) & small), None, 0
    while todo and len(live):  # the widest gap first
        number, gap, content = todo.pop()
        sizes, rest = lengths[live], left[live]
        if gap < sizes[0]:
            groups.append((number, gap, content))
            continue
        if best is None or len(best) <= gap or age > 40:
            best, age = best_values(prices[live], sizes, gap), 0
        chosen, narrower = best_filling(best, prices[live], sizes, gap, rest)
        age += 1
        times = min([number, *(int(rest[k]) // a for k, a in chosen.items())])
        for k, a in chosen.items():
            left[live[k]] -= times * a
        groups.append((times, narrower, (*content, *((int(sizes[k]), a) for k, a in chosen.items()))))
        if times < number:
            todo.append((number - times, gap, content))
        if (left[live] == 0).any():
            live, best = np.flatnonzero((left > 0) & small), None
    groups += todo
    open_sequences(small)
    return [(number, content) for number, _, content in groups]


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES, rounds: int = ROUNDS) -> list[Group]:
    """Sequences for ``histogram`` (length: pieces) as groups (number, ((length, pieces), ...))."""
    whole = [(histogram[capacity], ((capacity, 1),))] if histogram.get(capacity) else []
    lengths = np.array(sorted(l for l, n in histogram.items() if n > 0 and l < capacity), dtype=np.int64)
    if not len(lengths):
        return whole
    counts = np.array([histogram[int(l)] for l in lengths], dtype=np.int64)
    prices = weighted_prices(lengths, counts, capacity, classes, rounds)
    own = 0.999 * prices + 0.001 * lengths / capacity  # of equal prices the fuller sequence
    return whole + min((rounded(lengths, counts, own, capacity, waiting) for waiting in (FILLER, 0.0)), key=lambda made: sum(n for n, _ in made))


def runs_of(plan: list[tuple[int, tuple[tuple[int, int], ...]]]) -> np.ndarray:
    """The plan by length: rows (length, first rank, pieces per sequence, first sequence, first offset), sorted."""
    next_rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for number, content in plan:
        offset = 0
        for length, each in content:
            rows.append((length, next_rank[length], each, sequence, offset))
            next_rank[length] += number * each
            offset += length * each
        sequence += number
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _place(runs: np.ndarray):
    starts = (runs[:, 0] << 48) + runs[:, 1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            length, rank = rows["length"].to_numpy(np.int64), rows["rank"].to_numpy(np.int64)
            own = runs[np.searchsorted(starts, (length << 48) + rank, side="right") - 1]
            whole, rest = np.divmod(rank - own[:, 1], np.maximum(own[:, 2], 1))
            yield rows.drop(columns="rank").assign(sequence_id=own[:, 3] + whole, offset=own[:, 4] + rest * length)

    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents and their places; see the module for how.

    ``tokenizer_path`` is a file of the ``tokenizers`` library that every executor has,
    whose words do not span white space.
    """
    id_type = docs.schema[id_col].dataType
    kind = f"id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long"
    cut = _cut(tokenizer_path, capacity, end_id, isinstance(id_type, T.IntegralType))
    pieces = materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(cut, kind + ", bucket long, at long"))
    by_bucket = materialize(pieces.groupBy("length", "bucket").agg(F.count("*").alias("rows")))
    histogram = {r["length"]: r["n"] for r in by_bucket.groupBy("length").agg(F.sum("rows").alias("n")).collect()}
    runs = runs_of(plan_sequences(histogram, capacity))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.select("length", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("at")
    # both sides are dealt by length and bucket already, and the table of buckets is never sent whole
    ranked = pieces.withColumn("place", F.row_number().over(within) - 1).join(offsets.hint("merge"), ["length", "bucket"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))
    placed = ranked.mapInPandas(_place(runs), kind + ", sequence_id long, offset long")
    return placed.withColumnRenamed("id", clear_of(docs.select(id_col), *ADDED).columns[0])
