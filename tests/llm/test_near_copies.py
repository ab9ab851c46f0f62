"""The pipeline's near-copy stage against all pairs, on planted edits."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from tallyseq.llm import near_copies, simhash

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def planted():
    draw = random.Random(5)
    word = lambda: f"w{draw.randrange(3000)}"
    texts = [None, "", "one", "One", "two words"]
    for size, edits in [(100, 1), (100, 2), (300, 3), (300, 5), (300, 9), (1000, 10), (1000, 20), (1000, 24)] * 6:
        base = [word() for _ in range(size)]
        for _ in range(3):
            other = [*base]
            for at in draw.sample(range(size), edits):
                other[at] = "x" + word()
            texts.append(" ".join(other))
        texts.append(" ".join(base))
    draw.shuffle(texts)
    return texts


def crowded():
    """Texts that share most of their words in one passage, some with a near copy of their own."""
    draw = random.Random(6)
    word = lambda: f"w{draw.randrange(10**6)}"
    passage, texts = [word() for _ in range(80)], []
    for i in range(90):
        own = [word() for _ in range(24)]
        texts.append(" ".join(passage + own))
        if i % 3 == 0:
            texts.append(" ".join([*passage, *own[:-1], word()]))
    return texts


def test_common_passage(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "PAIRWISE", 1)
    monkeypatch.setattr(near_copies, "TILE", 8)
    one = lambda spots: spots.select("node", "n", F.lit(1).cast("long").alias("bucket")).distinct()  # noqa: E731  all texts share one bucket
    monkeypatch.setattr(near_copies, "_led", lambda spots, own=near_copies._led: own(one(spots)))
    met = []
    monkeypatch.setattr(near_copies, "_linked", lambda pairs, sets, own=near_copies._linked: met.append(pairs.count()) or own(pairs, sets))
    check(spark, crowded())  # runs the operator twice
    assert sum(met) / 2 < 120 * 119 / 2 / 4  # far from all pairs


def test_tiles():
    """The edges of a tile join what all pairs join, and are fewer than its members."""
    draw = np.random.default_rng(2)
    for _ in range(60):
        base = [np.unique(draw.integers(0, 2**40, 60)) for _ in range(5)]
        sets = [np.unique(b[draw.random(len(b)) < 0.95]) for b in base for _ in range(6)] + [np.empty(0, np.int64)]
        parts = draw.integers(0, 40, len(sets))
        tile = pd.DataFrame({"node": np.arange(len(sets)) * 7, "part": parts, "some": sets})
        edges = near_copies._tile_edges(tile)

        def joined(pairs, parts=parts):
            label = list(parts)
            for a, b in pairs:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
            return [label.index(x) for x in label]

        every = [(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b])) and len(sets[b])]
        assert joined(every) == joined((edges // 7).to_numpy()) and len(edges) < len(sets)


def test_planted_edits_are_found(spark):
    check(spark, planted())


def check(spark, texts):
    sets = [grams(t) for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if similarity(sets[a], sets[b]) >= 0.8 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    rows = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], KIND)
    assert {r.doc_id: r.component_id for r in near_copies.copy_groups(rows).collect()} == dict(enumerate(group))
    kept = corpus_pipeline.near_dedup_stage(spark, rows, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(group))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (4, "a b c d e f"), (4, "a b c d e f"), (4, "g h i j k"), (None, "no id")]
    table = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], KIND)
    assert sorted((r.doc_id or 0, r.text or "") for r in near_copies.keep_one(table).collect()) == [(0, "no id"), (1, ""), (4, "a b c d e f"), (4, "g h i j k")]
    assert near_copies.keep_one(table.limit(0)).count() == 0


def test_simhash_blocks_find_near_copies_by_themselves(spark, monkeypatch):
    dice = random.Random(8)
    rows = []
    for i in range(12):
        words = [f"w{dice.randrange(10**6)}" for _ in range(400)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:-1], "other"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    led = near_copies._led
    monkeypatch.setattr(near_copies, "_led", lambda spots: led(spots).limit(0))  # no bands
    found = {r.doc_id: r.component_id for r in near_copies.copy_groups(docs).collect()}
    assert all(c in (d, d - d % 2) for d, c in found.items())
    assert sum(found[2 * i + 1] == 2 * i for i in range(12)) >= 6


def test_near_fingerprints_are_checked_exactly(spark):
    classes = spark.createDataFrame([(1, 5), (2, 5), (3, 4), (4, -1)], "node long, fp long")
    near = near_copies._near_fingerprints(classes)
    assert sorted(map(tuple, near.collect())) == [(1, 2), (1, 3)]
    sets = spark.createDataFrame([(1, [1, 2, 3, 4, 5]), (2, [1, 2, 3, 4]), (3, [6])], "node long, some array<long>")
    assert [tuple(r) for r in near_copies._linked(near, sets).collect()] == [(1, 2)]


def test_block_keys_are_not_broadcast(spark):
    """A key for each fingerprint and choice of blocks: by the guess of a plan they are as few as the fingerprints."""
    fps = np.random.default_rng(1).integers(-(2**63), 2**63, 3000)
    near = fps[:50] ^ 5
    found = simhash.hamming_links(simhash.materialize(spark.createDataFrame([(int(x),) for x in np.concatenate([fps, near])], "fp long")))  # a file, whose size a plan knows
    assert {frozenset((r.src, r.dst)) for r in found.collect()} == {frozenset((int(a), int(b))) for a, b in zip(fps[:50], near, strict=True)}
    lines = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*|")) for x in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = lines[i + 1 : next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))]
            assert not any("Generate" in x for x in below)
