"""Lattice likelihoods against sums over all cuts; counts, folds and training against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyseq.llm import lattice_score, queries

DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.PIECE_VOCABULARY)


@pytest.fixture(scope="module")
def prior():
    return lattice_score.vocabulary(PATH)


def cuts(word, model):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in model:
            for rest in cuts(word[n:], model):
                yield [word[:n], *rest]


def test_vocabulary(prior):
    assert abs(math.fsum(prior.values()) - 1) < 1e-9 and min(prior.values()) > 0
    assert all(bytes([b]) in prior for b in range(256)) and not any(b" " in p[1:] for p in prior)


@pytest.mark.parametrize("word", [" the", " nation", " éléx", " a", " \xff\x00z".encode().decode()])
def test_all_cuts(prior, word):
    word = word.encode()
    table, longest = lattice_score.log_table(prior)
    every = [(c, math.prod(prior[p] for p in c)) for c in cuts(word, prior)]
    total = math.fsum(p for _, p in every)
    assert abs(lattice_score.forward(word, table, longest)[-1] - math.log(total)) < 1e-9
    want, got = Counter(), {}
    for c, p in every:
        for piece in c:
            want[piece] += 3 * p / total
    lattice_score.expect(word, 3, table, longest, got)
    assert all(abs(got.get(piece, 0) / lattice_score.PARTS - n) < 1e-5 for piece, n in want.items())


def test_many_at_once(prior):
    """Words of one length together, against one by one."""
    lattice = lattice_score.Lattice(prior)
    words = [w.encode() for w in ("the", "nation", "éléx", "a", "andreherend$$$", "tzeiner", "nations", "\x00", "ﬁx", "x" * 60)]
    places = []
    for some, data in lattice_score.by_length(words):
        places += some
        got = lattice.scores(data)
        into, want = {}, {}
        for state, n in zip(*lattice.expected(data, np.array([2**41 + i for i in some])), strict=True):
            into[lattice.names[state]] = n
        for i, score in zip(some, got, strict=True):
            assert abs(score - lattice_score.forward(b" " + words[i], lattice.table, lattice.longest)[-1]) < 1e-9
            lattice_score.expect(b" " + words[i], 2**41 + i, lattice.table, lattice.longest, want)
        assert set(into) ^ set(want) == set() or all(abs(into.get(p, 0) - want.get(p, 0)) <= 2**43 for p in set(into) | set(want))
        assert all(abs(into.get(p, 0) - n) <= 1e-6 * n + 2**43 for p, n in want.items())
    assert sorted(places) == list(range(len(words)))


def test_long_words(prior):
    """A word of any length has a finite logarithm, which grows by as much for each repetition."""
    table, longest = lattice_score.log_table(prior)
    one, two = (lattice_score.forward(b" " + b"xq" * n, table, longest)[-1] for n in (20_000, 40_000))
    assert -math.inf < two < one < 0 and abs(two / one - 2) < 1e-3


def brute(rows, prior):
    """Everything by the definitions, in one process."""
    words = {i: re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) for i, (_, t) in enumerate(rows)}
    held = {i: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for i, (d, _) in enumerate(rows)}
    count, ends = Counter(w for i in words if not held[i] for w in words[i]), sum(not h for h in held.values())
    tokens, kinds = count.total() + ends, len(count) + (ends > 0)
    model = prior
    for _ in range(lattice_score.ROUNDS):
        table, longest = lattice_score.log_table(model)
        into = {}
        for w, n in count.items():
            lattice_score.expect(b" " + w, n, table, longest, into)
        into = {p: n / lattice_score.PARTS for p, n in into.items()} | {b"": ends}
        model = {p: (into.get(p, 0) + lattice_score.PRIOR * q) / (sum(into.values()) + lattice_score.PRIOR) for p, q in prior.items()}
    table, longest = lattice_score.log_table(model)
    seen = {w: lattice_score.forward(b" " + w, table, longest)[-1] for w in {w for ws in words.values() for w in ws}}
    base = lambda n: math.log10((n + 1) / (tokens + kinds + 1))
    return [
        (d, held[i], len(words[i]) + 1, sum(w in count for w in words[i]) + (ends > 0), tokens, sum(base(count[w]) for w in words[i]) + base(ends), (sum(seen[w] for w in words[i]) + math.log(model[b""])) / math.log(10))
        for i, (d, _) in enumerate(rows)
    ]


def same(got, want):
    key = lambda r: (r[0] is None, *r)
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and all(abs(x - y) <= 1e-7 * (1 + abs(y)) for x, y in zip(a[5:], b[5:], strict=True))


def test_query(spark, prior):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_lattice_score(spark, DIR)
    same(got.collect(), brute(rows, prior))
    outside = [r for r in got.collect() if r.held_out]
    known = [r for r in got.collect() if not r.held_out]
    assert outside and sum(r.score for r in outside) / sum(r.n_tokens for r in outside) > 1.2 * sum(r.score for r in known) / sum(r.n_tokens for r in known)


def test_odd_rows(spark, monkeypatch, prior):
    """Few frequent words, small chunks and early flushes change nothing; long words, nulls, repeats."""
    monkeypatch.setattr(lattice_score, "CHUNK", 50)
    monkeypatch.setattr(lattice_score, "MOST_WORDS", 3)
    long = "wör" * 3_000
    rows = [(1, None), (2, ""), (3, "The the\x0bTHE end"), (3, "The the\x0bTHE end"), (None, "no id É\x00"), (4, f"{long} {long}x the"), (5, " not cut here"), (30, "held ▁ words " * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rid": F.lit("x"), "held": F.lit(1), "score": F.lit("y")})
    got = lattice_score.score_texts(docs, queries.fold(F.col("doc_id"), 7) == 2, PATH, hot_words=2)
    same(got.collect(), brute(rows, prior))
    renamed = lattice_score.score_texts(docs.select(F.col("doc_id").alias("score"), "text"), F.lit(True), PATH, "score")
    assert renamed.columns[0] == "score_input" and {(r.n_known, r.train_tokens) for r in renamed.collect()} == {(0, 0)}
    assert lattice_score.score_texts(docs.limit(0), F.lit(False), PATH).count() == 0
