"""Probability of a text under a unigram model of subwords, summed over all ways to cut it into pieces.

The pieces and their first weights come from an existing vocabulary: a piece's score there is its rank, which weighs it by
Zipf's law. These weights are a prior worth ``PRIOR`` pieces; the corpus moves them by ``ROUNDS`` steps of expectation
maximisation over the training words. A text is its words, each after a mark, then one end. No piece holds a mark but in
front, so cuts of different words are free of each other: the probability of a text is the product of those of its words,
each found by the forward recursion in log space over the word's bytes (every byte is a piece, so every word has a cut),
times that of the end. The amount of white space between words is not part of it.

The work follows the corpus: words are counted in tasks and by a shuffle, each distinct word is scored once, and a
word's count and score come back to the documents. Words with more than 1 / ``HOT_WORDS`` of all occurrences, at most
``HOT_WORDS`` by arithmetic and ``KEY_BYTES`` long each, are sent to the tasks; the others, each with few rows, meet the documents in
a join. The expected counts that reach the driver are one number per piece of the vocabulary. They are whole
numbers, so sums don't depend on the order of the tasks.

Words of one length go through the recursion together, as arrays over a table of transitions; those longer than ``KEY_BYTES`` go alone.

Memory: a task counts at most ``MOST_WORDS`` words or ``MOST_BYTES`` of text before it passes them on, long texts are cut at white
space for it, words longer than ``KEY_BYTES`` are compared by a digest, and the recursion keeps two numbers per byte of a word.

Defined results for odd input: a null or empty text is one end; a row whose id is null is learned from; repeated rows
count and score like others; with no text to learn from the prior scores alone, and every word is unknown; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, LongType, StructField, StructType

from tallyseq.llm.names import clear_of
from tallyseq.operators.skew import hot_limit
from tallyseq.session import materialize

MARK = b" "
#: The place of the end in a model; no piece is empty.
END = b""
PRIOR = 1000.0
ROUNDS = 2
HOT_WORDS = 400_000
KEY_BYTES = 64
MOST_WORDS = 400_000
MOST_BYTES = 1 << 26
CHUNK = 1 << 20
#: Parts of an expected occurrence.
PARTS = 1 << 24
#: In a table of log probabilities: no piece begins so, or pieces only begin so.
NOTHING, BEGINNING = 1.0, 2.0
#: Names within the program; an id named so comes out as name + ``_input``.
ADDED_NAMES = "held text rid words base log_p known rest rest_base rest_log_p rest_known held_out n_tokens n_known train_tokens base_score score".split()
#: Words that go through the recursion together.
TOGETHER = 2048
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def vocabulary(model_path: str) -> dict[bytes, float]:
    """Prior probabilities of the pieces of a sentence-piece file, of all single bytes, and of the end."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = model.get_piece_size()
    weights = {bytes([b]): 1.0 / size for b in range(256)}
    for i in range(size):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i)
        if "▁" not in piece[1:] and (rank := -model.get_score(i)) < size:
            data = piece.replace("▁", " ").encode()
            weights[data] = weights.get(data, 0.0) + 1.0 / (rank + 2.0)
    weights[END] = weights.get(MARK, 1.0 / size)
    total = math.fsum(weights.values())
    return {piece: w / total for piece, w in weights.items()}


def log_table(model: dict[bytes, float]) -> tuple[dict[bytes, float], int]:
    """Log probabilities of pieces, with ``BEGINNING`` for what pieces only begin with, and the longest piece's length."""
    table = {piece: math.log(p) for piece, p in model.items() if piece}
    for piece in list(table):
        for n in range(1, len(piece)):
            table.setdefault(piece[:n], BEGINNING)
    return table, max(map(len, table))


def forward(word: bytes, table: dict[bytes, float], longest: int) -> array:
    """Log of the summed probability of all cuts of each beginning of ``word``."""
    n, size, get = len(word), longest + 1, table.get
    open_: list[list[float]] = [[] for _ in range(size)]
    reached, now = array("d", [0.0]), 0.0
    for i in range(n + 1):
        if i:
            terms = open_[i % size]
            if len(terms) == 1:
                now = terms[0]
            else:
                top = max(terms)
                now = top + math.log(sum([math.exp(t - top) for t in terms]))
            terms.clear()
            reached.append(now)
        for j in range(i + 1, min(i + longest, n) + 1):
            p = get(word[i:j], NOTHING)
            if p <= 0:
                open_[j % size].append(now + p)
            elif p == NOTHING:
                break
    return reached


def expect(word: bytes, times: int, table: dict[bytes, float], longest: int, into: dict[bytes, int]) -> None:
    """Add the expected occurrences of pieces in ``times`` copies of ``word``, in whole ``PARTS``."""
    n, get = len(word), table.get
    reached = forward(word, table, longest)
    rest, total = array("d", bytes(8 * (n + 1))), reached[n]
    for i in range(n - 1, -1, -1):
        pieces, terms = [], []
        for j in range(i + 1, min(i + longest, n) + 1):
            p = get(piece := word[i:j], NOTHING)
            if p <= 0:
                pieces.append(piece)
                terms.append(p + rest[j])
            elif p == NOTHING:
                break
        top = max(terms)
        rest[i] = top + math.log(sum([math.exp(t - top) for t in terms]))
        here = reached[i] - total
        for piece, t in zip(pieces, terms, strict=True):
            if part := round(math.exp(here + t) * PARTS):
                into[piece] = into.get(piece, 0) + part * times


class Lattice:
    """A model as a table of transitions between beginnings of pieces: state 0 leads nowhere, state 1 is the empty beginning."""

    def __init__(self, model: dict[bytes, float]):
        self.table, self.longest = log_table(model)
        self.names = [b"", b"", *self.table]
        number = {name: i for i, name in enumerate(self.names)}
        number[b""] = 1
        self.step = np.zeros((len(self.names), 256), np.int32)
        self.log_p = np.full(len(self.names), -np.inf)
        for i, name in enumerate(self.names[2:], 2):
            self.step[number[name[:-1]], name[-1]] = i
            if (p := self.table[name]) <= 0:
                self.log_p[i] = p

    def _states(self, words: np.ndarray) -> list[np.ndarray]:
        """For each length of a piece, the state that it reaches from each place of each word."""
        out, state = [], np.ones(words.shape, np.int32)
        for size in range(1, min(words.shape[1], self.longest) + 1):
            state = self.step[state[:, : words.shape[1] - size + 1], words[:, size - 1 :]]
            if not state.any():
                break
            out.append(state)
            state = state[:, :-1] if state.shape[1] > 1 else state
        return out

    def reached(self, words: np.ndarray, logs: list[np.ndarray]) -> np.ndarray:
        """Log of the summed probability of all cuts of each beginning."""
        n = words.shape[1]
        alpha = np.full((len(words), n + 1), -np.inf)
        alpha[:, 0] = 0.0
        for j in range(1, n + 1):
            alpha[:, j] = _log_sum([alpha[:, j - k] + logs[k - 1][:, j - k] for k in range(1, min(j, len(logs)) + 1)])
        return alpha

    def scores(self, words: np.ndarray) -> np.ndarray:
        """Log probability of each row of bytes."""
        return self.reached(words, [self.log_p[s] for s in self._states(words)])[:, -1]

    def expected(self, words: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States of pieces and their expected occurrences in whole ``PARTS``, as Python numbers."""
        n, states = words.shape[1], self._states(words)
        logs = [self.log_p[s] for s in states]
        alpha = self.reached(words, logs)
        beta = np.full((len(words), n + 1), -np.inf)
        beta[:, n] = 0.0
        for i in range(n - 1, -1, -1):
            beta[:, i] = _log_sum([logs[k - 1][:, i] + beta[:, i + k] for k in range(1, min(n - i, len(logs)) + 1)])
        high, low = (np.zeros(len(self.names), np.int64) for _ in range(2))
        for k, (state, log_p) in enumerate(zip(states, logs, strict=True), 1):
            parts = np.rint(np.exp(alpha[:, : n - k + 1] + log_p + beta[:, k:] - alpha[:, n:]) * PARTS).astype(np.int64)
            some = np.nonzero(parts)
            part, own = parts[some], times[some[0]]
            np.add.at(low, state[some], part * (own & 0xFFFFF))
            np.add.at(high, state[some], part * (own >> 20))
        held = np.flatnonzero((low > 0) | (high > 0))
        return held, low[held].astype(object) + high[held].astype(object) * (1 << 20)


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    if len(terms) == 1:
        return terms[0]
    stacked = np.stack(terms)
    top = stacked.max(axis=0)
    return top + np.log(np.exp(stacked - top).sum(axis=0))


def by_length(words: list[bytes]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Marked words of up to ``KEY_BYTES`` in groups of one length: their places, and a row of bytes for each."""
    places: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if len(word) <= KEY_BYTES:
            places.setdefault(len(word), []).append(i)
    for size, at in places.items():
        for k in range(0, len(at), TOGETHER):
            some = at[k : k + TOGETHER]
            data = np.frombuffer(b"".join([MARK + words[i] for i in some]), np.uint8)
            yield some, data.reshape(len(some), size + len(MARK))


def text_words(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text, A to Z in lower case, in lists of about ``CHUNK`` bytes."""
    at, text = 0, text or b""
    while at < len(text):
        cut = _SPACE.search(text, at + CHUNK)
        end = cut.end() if cut else len(text)
        yield text[at:end].lower().split()
        at = end


def key_of(word: bytes) -> bytes:
    return word if len(word) <= KEY_BYTES else b"\xff" + hashlib.blake2b(word).digest()


def count_words(docs: DataFrame) -> DataFrame:
    """Words as (key, word: only if the key is a digest, trained, seen): occurrences in rows to learn from and in all.

    ``docs``: held boolean, text binary.
    """
    schema = pa.schema([("key", pa.binary()), ("word", pa.binary()), ("trained", pa.int64()), ("seen", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, read = (Counter(), Counter()), 0

        def flush() -> Iterator[pa.RecordBatch]:
            for held, words in enumerate(found):
                items = list(words.items())
                for k in range(0, len(items), 50_000):
                    w, n = zip(*items[k : k + 50_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(map(key_of, w), pa.binary()), pa.array([x if len(x) > KEY_BYTES else None for x in w], pa.binary()), pa.array([0] * len(n) if held else n, pa.int64()), pa.array(n, pa.int64())], schema=schema)
                words.clear()

        for batch in batches:
            for held, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for words in text_words(text.as_py()):
                    found[held].update(words)
                    read += sum(map(len, words)) if len(words) < 64 else CHUNK
                    if read > MOST_BYTES or len(found[0]) + len(found[1]) > MOST_WORDS:
                        yield from flush()
                        read = 0
        yield from flush()

    rows = docs.select("held", "text").mapInArrow(count, "key binary, word binary, trained long, seen long")
    return rows.groupBy("key", "word").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen"))


def train(words: DataFrame, ends: int, prior: dict[bytes, float], rounds: int = ROUNDS) -> dict[bytes, float]:
    """Probabilities of pieces and the end after ``rounds`` steps from the prior; words are (key, word, trained)."""
    learned = words.where("trained > 0").select(F.coalesce("word", "key").alias("word"), "trained")
    model = prior
    for _ in range(rounds):

        def expected(batches: Iterable[pa.RecordBatch], model: dict = model) -> Iterator[pa.RecordBatch]:
            lattice, into = Lattice(model), {}
            for batch in batches:
                words, times = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                for some, data in by_length(words):
                    for state, parts in zip(*lattice.expected(data, times[some]), strict=True):
                        into[lattice.names[state]] = into.get(lattice.names[state], 0) + parts
                for word, n in zip(words, times.tolist(), strict=True):
                    if len(word) > KEY_BYTES:
                        expect(MARK + word, n, lattice.table, lattice.longest, into)
            yield pa.RecordBatch.from_arrays([pa.array(into, pa.binary()), pa.array(map(Decimal, into.values()), pa.decimal128(38, 0))], ["piece", "parts"])

        sums = learned.mapInArrow(expected, "piece binary, parts decimal(38,0)").groupBy("piece").agg(F.sum("parts").alias("parts"))
        found = {bytes(r.piece): float(r.parts) / PARTS for r in sums.collect()}  # one row per piece of the vocabulary at most
        found[END] = float(ends)
        total = math.fsum(found.values()) + PRIOR
        model = {piece: (found.get(piece, 0.0) + PRIOR * p) / total for piece, p in prior.items()}
    return model


def score_words(words: DataFrame, model: dict[bytes, float]) -> DataFrame:
    """Add ``log_p``, the log probability of a word over all its cuts."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model)
        for batch in batches:
            words = [word or key for key, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            told = np.zeros(len(words))
            for some, data in by_length(words):
                told[some] = lattice.scores(data)
            for i, word in enumerate(words):
                if len(word) > KEY_BYTES:
                    told[i] = forward(MARK + word, lattice.table, lattice.longest)[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(told)], ["key", "trained", "seen", "log_p"])

    return words.select("key", "word", "trained", "seen").mapInArrow(score, "key binary, trained long, seen long, log_p double")


def _hot_lookup(table: bytes) -> tuple[dict[bytes, int], np.ndarray]:
    """The place of each frequent word and, per place, its base and model logarithms and whether it is known."""
    rows = pa.ipc.open_stream(table).read_all()
    values = np.stack([rows.column(c).to_numpy().astype(float) for c in ("base", "log_p", "known")], axis=1).reshape(-1, 3)
    return {key: n for n, key in enumerate(rows.column("key").to_pylist())}, values


def _ipc(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _first_pass(docs: DataFrame, hot: pa.Table, id_col: str) -> DataFrame:
    """Per row: its id, tokens, sums over frequent words, and the other words with their numbers as ``rest``."""
    sent = docs.sparkSession.sparkContext.broadcast(_ipc(hot))
    fields = [docs.schema[id_col], StructField("rid", LongType()), StructField("held", BooleanType()), StructField("words", LongType()), *[StructField(c, DoubleType()) for c in ("base", "log_p", "known")]]
    fields.append(StructField("rest", ArrayType(StructType([StructField("key", BinaryType()), StructField("times", LongType())]))))
    kept: dict = {}

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept["hot"] = _hot_lookup(sent.value)
        places, values = kept["hot"]
        rest_type = pa.list_(pa.struct([("key", pa.binary()), ("times", pa.int64())]))
        for batch in batches:
            n_words, sums, rests = [], [], []
            for text in batch.column(3):
                words: Counter = Counter()
                for some in text_words(text.as_py()):
                    words.update(some)
                at, times, rest = [], [], []
                for word, n in words.items():
                    place = places.get(key := key_of(word))
                    if place is None:
                        rest.append({"key": key, "times": n})
                    else:
                        at.append(place)
                        times.append(n)
                n_words.append(words.total())
                sums.append(np.array(times, float) @ values[at] if at else np.zeros(3))
                rests.append(rest)
            told = np.array(sums).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(n_words, pa.int64()), *[pa.array(told[:, k]) for k in range(3)], pa.array(rests, rest_type)], [f.name for f in fields])

    return docs.select(id_col, "rid", "held", "text").mapInArrow(look, StructType(fields))


def score_texts(docs: DataFrame, held_out: Column, model_path: str, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, hot_words: int = HOT_WORDS) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    ``held_out`` tells which rows are not learned from. The base is a unigram of whole words with one added to every count.
    """
    own = clear_of(docs.select(id_col), *ADDED_NAMES).columns[0]
    rows = docs.select(F.col(id_col).alias(own), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text_col).cast("binary").alias("text"), F.monotonically_increasing_id().alias("rid"))
    words = materialize(count_words(rows))
    ends = rows.where(~F.col("held")).count()
    totals = words.agg(F.sum("trained").alias("tokens"), F.count_if(F.col("trained") > 0).alias("distinct"), F.sum("seen").alias("seen")).first()
    tokens, distinct, seen = (totals.tokens or 0) + ends, totals.distinct + (ends > 0), totals.seen or 0
    below = float(tokens + distinct + 1)
    model = train(words, ends, vocabulary(model_path), rounds)
    scored = materialize(score_words(words, model)).withColumns({"base": F.log10((F.col("trained") + 1) / F.lit(below)), "known": (F.col("trained") > 0).cast("double")})
    limit = hot_limit(seen, hot_words)
    hot = scored.where(F.col("seen") > limit).select("key", "base", "log_p", "known").toArrow()  # fewer than hot_words rows
    found = materialize(_first_pass(rows, hot, own))
    rest = found.select("rid", F.explode("rest").alias("r")).select("rid", "r.key", "r.times").join(scored.where(F.col("seen") <= limit), "key")
    sums = rest.groupBy("rid").agg(*[F.sum(F.col("times") * F.col(c)).alias(f"rest_{c}") for c in ("base", "log_p", "known")])
    whole = lambda c: F.col(c) + F.coalesce(f"rest_{c}", F.lit(0.0))
    end_base, end_log = math.log10((ends + 1) / below), math.log(model[END])
    return found.drop("rest").join(sums, "rid", "left").select(
        F.col(own),
        F.col("held").alias("held_out"),
        (F.col("words") + 1).alias("n_tokens"),
        (whole("known") + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (whole("base") + end_base).alias("base_score"),
        ((whole("log_p") + end_log) / math.log(10)).alias("score"),
    )
