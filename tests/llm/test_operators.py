"""The text operators against brute force on small tables, and on odd input."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyseq.llm import chat_windows, html_main, license_scan, mixing, packing, quality_rules, queries, ranker, simhash, sphere_filters, token_spans

DIR = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "one", "en", "a", 3),
    (4, "the same words again and again the same words again and again\n" * 3, "en", None, 9),
    (4, "the same words again and again the same words again and again\n" * 3, "en", None, 9),
    (5, "mit license " * 3000, "en", "b", 1),
    (6, "Ünïcode ́ \U0001f600 漢字 \t\x0b\x0c x", "en", "b", 1),
    (None, "no id here", "en", "b", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, KIND)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def run(spark, name):
    return queries.queries()[name](spark, DIR).toPandas()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_license_scan(spark, docs, odd):
    def brute(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = sorted((i, label) for phrase, label in license_scan.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())
        return len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))

    rows = license_scan.license_scan(docs.select("text").union(odd.select("text"))).select("text", "licenses.*").collect()
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(r.text)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert license_scan.scan_text("SPDX-License-Identifier: BSD-3-Clause")[5] == "bsd-3-clause"
    assert license_scan.scan_text("GNU Lesser General Public License version 3")[5] == "gpl,lgpl-3.0"
    assert len(license_scan.RULES) > 300


def check_packing(found, source):
    path = public_tokenizers.path(queries.PACK_TOKENIZER)
    tokenizer = packing.ChunkEncoder.of(path).tokenizer
    want = Counter()
    for id_, text in source:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            some = ids[start : start + 4096]
            want[id_, piece, start, len(some), zlib.crc32(np.array(some, "<u4").tobytes())] += 1
    null = lambda x: None if pd.isna(x) else int(x)
    assert want == Counter((null(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found.itertuples())
    for _, rows in found.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *rows.length.cumsum().tolist()[:-1]] and rows.length.sum() <= 4096
    assert found.sequence_id.nunique() <= -(-found.length.sum() // 4096) + 1


def test_packing(spark, docs, odd):
    check_packing(run(spark, "op2_best_fit_packing"), [(r.doc_id, r.text) for r in docs.collect()])
    path = public_tokenizers.path(queries.PACK_TOKENIZER)
    check_packing(packing.pack(odd, path).toPandas(), [(r[0], r[1]) for r in ODD])
    assert packing.pack(odd.limit(0), path).count() == 0


def test_mixing(spark, odd, docs):
    found = run(spark, "op3_source_mixing").sort_values("doc_id").reset_index(drop=True)
    again = run(spark, "op3_source_mixing").sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(found, again)
    size = {r.doc_id: len(words(r.text)) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    total = defaultdict(int)
    for i, s in source.items():
        total[s] += size[i]
    names = sorted(total)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(total.values()))
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * total[s] < level * weight[s]}
        if not full:
            break
        for s in full:
            target[s] = 3.0 * total[s]
            left -= target[s]
        open_ -= full
    target |= {s: level * weight[s] for s in open_}
    taken, longest = defaultdict(int), defaultdict(int)
    for r in found.itertuples():
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == total[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert r.taken <= 3 * r.size
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in names)
    assert mixing.mix_table(odd).count() == len(ODD) and mixing.mix_table(odd.limit(0)).count() == 0
    extra = odd.withColumns({"whole": F.lit(1), "place": F.lit("x")})
    assert mixing.mix_documents(extra).columns == extra.columns


def test_quality_statistics(spark, docs, odd):
    rows = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    for r in quality_rules.judge(rows, []).collect():
        w = words(r.text)
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count, inside = Counter(grams), set()
        for i, g in enumerate(grams):
            if count[g] > 1:
                inside.update(range(i, i + 5))
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(inside))
        assert tuple(r["__stat_" + c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert (r.rejected_by == -1) == (len(w) < 10 or 100 * len(inside) > 20 * len(w))


def test_rules_are_learned(spark):
    rows = [(i % 4 and 1, i % 3 == 0, float(i % 4 == 0) + 0.1 * (i % 5), float(i % 7)) for i in range(400)]
    rules = quality_rules.learn_rules(spark.createDataFrame(rows, "label int, prune boolean, a double, b double"), ["a", "b"])
    assert rules and rules[0][0].feature == "a" and rules[0][0].above
    assert quality_rules.learn_rules(spark.createDataFrame([], "label int, prune boolean, a double"), ["a"]) == []


def test_ranking(spark, odd):
    data = "/root/testdata/sf0.01"
    found = queries.op8_quality_classifier(spark, data).toPandas()
    labels = spark.read.parquet(f"{data}/labels.parquet").toPandas().set_index("doc_id").quality
    held = found[found.held_out & found.doc_id.isin(labels.index)]
    assert ((held.predicted == 1) == (held.doc_id.map(labels) == 1)).mean() > 0.95
    assert found.score.between(0, 1).all() and (found.held_out == found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    none = ranker.fit(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert {round(r.score, 9) for r in ranker.score(odd, none).collect()} == {0.5}


def test_chat_windows(spark):
    found = run(spark, "op5_chat_windows").set_index("conv_id")
    turns = spark.read.parquet(f"{DIR}/conversations.parquet").toPandas().sort_values(["conv_id", "turn"])
    groups = {k: list(zip(g.role, g.text.fillna(""), strict=True)) for k, g in turns.groupby("conv_id")}
    groups[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(groups) == set(found.index)
    for k, g in groups.items():
        loss = "".join(t for r, t in g if r == "assistant")
        assert found.n_turns[k] == len(g) and found.loss_chars[k] == len(loss)
        assert found.turns_sha256[k] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in g).encode()).hexdigest()
        assert found.loss_sha256[k] == hashlib.sha256(loss.encode()).hexdigest()


def test_html(spark):
    page = "<html><body><nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>A &amp; B</h1><p>One  two<br>three.<p>Four <b>five</b> six.</p></article><footer>&copy; x</footer></body></html>"
    rows = spark.createDataFrame([(1, None), (2, ""), (3, page), (4, page[:150])], "page_id long, html string")
    got = {r.page_id: r.text for r in html_main.extract_pages(rows).collect()}
    assert got[1] == got[2] == "" and got[3] == "A & B\nOne two three.\nFour five six."
    x, y = html_main.training_rows(40, 77)
    assert ((html_main.train().margin(x) > 0) == (y == 1)).mean() > 0.97


def union_low(ids, linked):
    low = dict(zip(range(len(ids)), ids, strict=True))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return [low[i] for i in range(len(ids))]


def test_simhash(spark, docs, odd):
    def brute(text):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = words(w)
        parts = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        votes = [sum(xxhash.xxh64_intdigest(p.encode(), 42) >> b & 1 for p in parts) for b in range(64)]
        return sum(1 << b for b in range(64) if 2 * votes[b] > len(parts))

    found = run(spark, "op7_simhash_near_dedup").sort_values("doc_id")
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = [brute(texts[i]) for i in found.doc_id]
    assert found.fingerprint.tolist() == [f"{x:016x}" for x in fps]
    linked = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    assert found.component_id.tolist() == union_low(found.doc_id.tolist(), linked)
    kept = simhash.keep_one(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 1), (False, 3), (False, 4), (False, 5), (False, 6), (True, 0)]


def test_simhash_tiles_equal_pairs(spark):
    draw = np.random.default_rng(1)
    base = int(draw.integers(0, 2**63))
    fps = sorted({base ^ sum(1 << int(b) for b in draw.choice(63, draw.integers(0, 4), replace=False)) for _ in range(400)})
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    parts = [simhash.connected_components(simhash.hamming_links(table, pairwise=p, tile=t)).groupBy("component").count().count() for p, t in ((10**6, 64), (4, 64))]
    assert parts[0] == parts[1]


def test_token_counts(spark, odd):
    path = public_tokenizers.path(queries.RANK_TOKENIZER)
    encoding, sizes = token_spans.load(path, public_tokenizers.PATTERN)
    found = token_spans.token_counts(odd.withColumn("section", F.lit(1)), path, public_tokenizers.PATTERN).toPandas()
    for id_, text, *_ in ODD[1:3] + ODD[5:7]:
        rows = found[found.doc_id == id_].sort_values("section")
        assert rows.n_tokens.sum() == len(encoding.encode_ordinary(text))
        assert [text[a:b] for a, b in zip(rows.start_char, rows.end_char, strict=True)] == (text.splitlines(keepends=True) if "\n" in text else [text])
    tokens, crossing = token_spans.attribute(np.array([2, 5, 9]), np.array([3, 4, 9]))
    assert tokens.tolist() == [2, 0, 1] and crossing.tolist() == [1, 0, 0]


def test_embeddings(spark):
    draw = np.random.default_rng(2)
    centre = draw.standard_normal((12, 64))
    rows = [(i, (centre[i % 12] + draw.standard_normal(64) * (0.02 + 0.3 * (i % 3 == 0))).tolist()) for i in range(150)]
    rows += [(500 + i, rows[7][1]) for i in range(5)] + [(600, None), (601, [0.0] * 64), (602, [float("nan")] * 64), (603, [1.0]), (604, [None] * 64)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sphere_filters.embedding_duplicates(table, tile=16).toPandas().sort_values("vec_id")
    ok = [(i, np.array(v)) for i, v in rows if i < 600]
    x = np.stack([v / np.linalg.norm(v) for _, v in ok])
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    linked = [(a, b) for a, b in zip(*np.nonzero(near), strict=True) if b < a]
    got = found[found.vec_id < 600]
    assert got.n_links.tolist() == near.sum(1).tolist()
    assert got.component_id.tolist() == union_low([i for i, _ in ok], linked)
    assert (found[found.vec_id >= 600].n_links == 0).all() and found[found.vec_id >= 600].kept.all()


def test_pipeline(spark):
    found = corpus_pipeline.run(spark, DIR).toPandas()
    kept = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.materialize(stage(spark, kept, DIR))
    check_packing(found, [(r.doc_id, r.text) for r in kept.collect()])
