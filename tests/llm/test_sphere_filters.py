"""Embedding near-duplicates: recall at the threshold, tiles against pairs, odd input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyseq.llm import sphere_filters


@pytest.mark.parametrize(("cosine", "words", "least"), [(0.95, 50, 0.99), (0.96, 50, 0.99), (0.95, 300, 0.97), (0.95, 600, 0.97), (0.95, 1000, 0.97), (0.95, sphere_filters.MOST_WORDS, 0.97)])
def test_recall_near_the_threshold(cosine, words, least):
    draw, n, dim = np.random.default_rng(4), 3000, 64
    codes = sphere_filters.codes_for(words, 6)
    v, u = (draw.standard_normal((n, dim)) for _ in range(2))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    u -= (u * v).sum(axis=1, keepdims=True) * v
    w = cosine * v + math.sqrt(1 - cosine**2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    a, b = (sphere_filters.filters_of([*x], words, 6, codes, 7) for x in (v, w))
    met = [bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
    assert np.mean(met) >= least


def test_decode_finds_the_best_directions():
    code = sphere_filters.ProductCode(16, 5, 6, 1)
    x = sphere_filters.units([*np.random.default_rng(3).standard_normal((20, 16))])
    every = np.array([[np.concatenate([code.books[0][a], code.books[1][b], code.books[2][c], code.books[3][d]]) for d in range(5)] for a in range(5) for b in range(5) for c in range(5)]).reshape(-1, 16)
    want = np.argsort(-(x @ code.rotation.T @ every.T), axis=1)[:, :6]
    assert np.array_equal(np.sort(want, axis=1), np.sort(code.decode(x), axis=1))


def test_tiles_equal_pairs(spark):
    draw = np.random.default_rng(8)
    centre = draw.standard_normal((3, 32))
    rows = [(i, (centre[i % 3] + draw.standard_normal(32) * 0.15).tolist()) for i in range(160)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = ((x @ x.T >= 0.95).sum(axis=1) - 1).tolist()
    for pairwise, tile in ((1, 16), (8, 512), (200, 512)):
        got = sphere_filters.embedding_duplicates(table, pairwise=pairwise, tile=tile).orderBy("vec_id").collect()
        assert [r.n_links for r in got] == want


def test_odd_vectors(spark):
    rows = [("a", [1.0, 2.0]), ("a", [1.0, 2.0]), ("b", [2.0, 4.0]), ("c", [1.0]), (None, [3.0]), ("d", [-1.0]), ("e", None), ("f", []), ("g", [0.0, 0.0]), ("h", [1e300, 1e300]), ("i", [1e-300, 1e-300])]
    table = spark.createDataFrame(rows, "n_links string, embedding array<double>").withColumn("rep", F.lit(1))
    got = sphere_filters.embedding_duplicates(table, "n_links").collect()
    told = sorted((r.n_links_input or "", r.n_links, r.component_id or "") for r in got)
    assert told == [("", 1, "c"), ("a", 2, "a"), ("a", 2, "a"), ("b", 2, "a"), ("c", 1, "c"), ("d", 0, "d"), ("e", 0, "e"), ("f", 0, "f"), ("g", 0, "g"), ("h", 1, "h"), ("i", 1, "h")]
    assert sphere_filters.embedding_duplicates(table.limit(0), "n_links").count() == 0
