"""Clashing names, repeated ids, empty tables and very long texts; queries and pipeline stages against brute force."""

import bisect
import math
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyseq.llm import html_main, license_scan, mixing, near_copies, packing, quality_rules, queries, ranker, simhash, text_stats, token_spans
from tallyseq.llm.names import clear_of

DIR = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "licensed under the mit license. words and words again. " * 40_000
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (4, "same row", "en", None, 9),
    (4, "same row", "en", None, 9),
    (4, "same id with another text", "en", "b", 9),
    (5, LONG, "en", "b", 1),
    (None, "no id here", "en", "b", 1),
]
RANKS = public_tokenizers.path(queries.RANK_TOKENIZER), public_tokenizers.PATTERN
PACK = public_tokenizers.path(queries.PACK_TOKENIZER)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, KIND)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DIR}/labels.parquet")


def test_names_that_clash(spark, rows):
    assert clear_of(rows.withColumnRenamed("lang", "Score"), "score").columns[2] == "Score_input"
    with_names = lambda *names: rows.select("doc_id", "text", *[F.lit("mine").alias(n) for n in names])
    none = ranker.fit(rows, spark.createDataFrame([], "doc_id long, quality int"))
    added = {
        "licenses": license_scan.license_scan(with_names("licenses", "__row")),
        "score": ranker.score(with_names("score", "__words"), none),
        "rejected_by": quality_rules.judge(with_names("rejected_by", "__words", "__lines", "__stat_n_words"), []),
        "section": token_spans.token_counts(with_names("section", "n_tokens", "value"), *RANKS),
    }
    for name, found in added.items():
        assert {name, f"{name}_input"} <= set(found.columns) and len({*found.columns}) == len(found.columns)
        assert {r[0] for r in found.select(f"{name}_input").distinct().collect()} == {"mine"}
        assert found.count() >= len(ROWS)
    assert {"__words", "__lines", "__stat_n_words_input"} <= set(added["rejected_by"].columns)
    page = rows.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), F.lit("mine").alias("text"))
    assert html_main.extract_pages(page).columns == ["page_id", "html", "text_input", "text"]
    odd = rows.select(F.col("doc_id").cast("string").alias("length"), "text", F.lit("x").alias("piece"), F.lit("__key").alias("__own_key"), F.lit(1).alias("__text_key"))
    assert packing.pack(odd, PACK, "length").columns[0] == "length_input" and packing.pack(odd, PACK, "length").count() > len(ROWS)
    found = simhash.near_duplicates(odd.withColumnRenamed("length", "fingerprint"), "fingerprint")
    assert found.columns[:2] == ["fingerprint_input", "fingerprint"] and found.count() == len(ROWS)
    for keep in (simhash.keep_one, near_copies.keep_one):
        kept = keep(odd, "length")
        assert kept.columns == odd.columns and sorted((r.length or "") for r in kept.collect()) == ["", "1", "4", "4", "5"]
    assert mixing.mix_table(odd.withColumnRenamed("length", "size").withColumn("source", F.lit("s")), "size").columns[:2] == ["size_input", "size"]


def test_empty_tables(spark, rows, labels):
    none = rows.limit(0)
    assert license_scan.license_scan(none).count() == 0 and token_spans.token_counts(none, *RANKS).count() == 0
    assert quality_rules.keep_good(none, quality_rules.fit(none, labels)).count() == 0
    assert ranker.keep_good(none, ranker.fit(none, labels)).count() == 0
    assert simhash.keep_one(none).count() == 0 and near_copies.keep_one(none).count() == 0


def test_bound_on_labelled_rows(spark):
    many = spark.range(300).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    one = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert text_stats.labelled_features(many, one, 1).count() == 1
    assert text_stats.labelled_features(many, one, 50).count() == 50


def test_license_query(spark, docs):
    """Every rule on every text without a prefilter, all detections held against all others."""

    def brute(text):
        norm = license_scan.normalised(text)
        found = [(m.start(), m.end(), r.priority, n) for n, r in enumerate(license_scan.RULES) for m in r.pattern.finditer(norm)]
        inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1]
        better = lambda a, b: (a[2], a[0] - a[1], a[3], a[0]) < (b[2], b[0] - b[1], b[3], b[0])
        kept = []
        for one in sorted(found, key=lambda x: (x[2], x[0] - x[1], x[3], x[0])):
            if not any(inside(one, k) and better(k, one) for k in kept):
                kept.append(one)
        kept = [a for a in kept if not any(b is not a and inside(b, a) and b[2] < a[2] for b in kept)]
        word = lambda at: norm.count(b" ", 0, at)
        spans = sorted(f"{license_scan.RULES[n].label}:{word(a)}-{word(b) + 1}" for a, b, _, n in kept)
        base = {label for _, label in license_scan.base_places(norm)}
        return spans, ",".join(sorted(base | {license_scan.RULES[n].label for *_, n in kept}))

    texts = {r.doc_id: r.text for r in docs.collect()}
    got = queries.op1_license_scan(spark, DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (sorted(r.spans), r.labels) == brute(texts[r.doc_id])


def features(text):
    """The features of a text, by the definitions alone."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    count, inside = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), set()
    for i in range(len(w) - 4):
        if count[tuple(w[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    chars, words, n = max(1, sum(map(len, w))), max(1, len(w)), max(1, len(lines))
    return {
        "words": float(len(w)),
        "word_length": sum(map(len, w)) / words,
        "symbol_rate": len(re.findall(r"[#*$%&|<>]", text)) / words,
        "dup_line_rate": (len(lines) - len(set(lines))) / n,
        "repeat_rate": len(inside) / words,
        "distinct_rate": len(set(w)) / words,
        "upper_rate": sum(unicodedata.category(c) == "Lu" for c in text) / chars,
        "digit_rate": len(re.findall("[0-9]", text)) / chars,
        "shout_rate": text.count("!") / words,
        "open_line_rate": sum(not re.search(r"[.!?:;,\"')\]][\x20\x09-\x0D]*$", x) for x in lines) / n,
    }


def rejected(rules, f):
    if f["words"] < 10 or 100 * f["repeat_rate"] * max(1, f["words"]) > 20 * f["words"] + 1e-9:
        return -1
    ok = lambda c: f[c.feature] > c.threshold if c.above else f[c.feature] <= c.threshold
    return next((n for n, rule in enumerate(rules, 1) if all(map(ok, rule))), 0)


def scored(ranking, f):
    total = 0.0
    for name, cuts, weights in zip(ranking.names, ranking.cuts, ranking.weights, strict=True):
        if cuts:
            total += [0.0, *np.cumsum(weights)][bisect.bisect_left(cuts, f[name])]
    return 1 / (1 + math.exp(-(ranking.slope * (total - ranking.cut) + math.log(ranker.DECISION / (1 - ranker.DECISION)))))


def test_rules_and_ranking_queries(spark, docs, labels):
    told = {r.doc_id: features(r.text) for r in docs.collect()}
    rules = quality_rules.fit(docs, labels)
    assert rules
    for r in queries.op4_quality_rules(spark, DIR).collect():
        number = rejected(rules, told[r.doc_id])
        assert (r.rejected_by, r.base_failed, r.kept) == (number, number == -1, number == 0)
    ranking = ranker.fit(docs, labels, keep=queries.fold(F.col("__label_id")) != 0)
    for r in queries.op8_quality_classifier(spark, DIR).collect():
        want = scored(ranking, told[r.doc_id])
        assert abs(r.score - want) < 1e-6 and r.predicted == int(r.score >= 0.3)


def test_token_query(spark, docs):
    encoding, _ = token_spans.load(*RANKS)
    want = {}
    for r in docs.collect():
        lines = (r.text or "").split("\n")
        pieces = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
        ends = np.cumsum([len(x.encode()) for x in pieces]).tolist()
        tokens, crossing, at = [0] * len(pieces), [0] * len(pieces), 0
        for t in encoding.decode_tokens_bytes(encoding.encode_ordinary(r.text or "")):
            shares = defaultdict(int)
            for k in range(at, at + len(t)):
                shares[bisect.bisect_right(ends, k)] += 1
            at += len(t)
            owner = max(shares, key=lambda s: (shares[s], -s))
            tokens[owner] += 1
            crossing[owner] += len(shares) > 1
        chars = [0, *np.cumsum([len(x) for x in pieces]).tolist()]
        want |= {(r.doc_id, s): (chars[s], chars[s + 1], tokens[s], crossing[s]) for s in range(len(pieces))}
    got = queries.op9_token_counts(spark, DIR).collect()
    assert {(r.doc_id, r.section): (r.start_char, r.end_char, r.n_tokens, r.n_crossing) for r in got} == want and len(got) == len(want)


def test_pipeline_stages(spark, docs, labels):
    """What each stage keeps, against its definition on the rows that it got."""
    rows, stages = docs, dict(corpus_pipeline.STAGES)
    run = lambda name: corpus_pipeline.materialize(stages[name](spark, rows, DIR))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    texts = {r.doc_id: r.text for r in docs.collect()}
    told = {i: features(t) for i, t in texts.items()}
    rules = quality_rules.fit(docs, labels)
    after = run("quality_rules")
    assert ids(after) == sorted(i for i in texts if rejected(rules, told[i]) == 0)
    rows, ranking = after, ranker.fit(docs, labels)
    after = run("quality_classifier")
    assert ids(after) == [i for i in ids(rows) if scored(ranking, told[i]) >= ranker.DECISION]
    rows = after
    after = run("near_dedup")
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (texts[i] or "").lower().split()) else set() for i in ids(rows)}
    group = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in pairs:
            group[a] = group[b] = min(group[a], group[b])
    assert ids(after) == sorted(set(group.values()))
    rows = after
    after = run("source_mixing")
    assert after.columns == docs.columns
    copies = Counter(ids(after))
    table = mixing.mix_table(rows).toPandas()
    assert {r.doc_id: r.copies for r in table.itertuples() if r.copies} == dict(copies) and max(copies.values()) <= 3
    odd = spark.createDataFrame([r for r in ROWS if r[1] != LONG], KIND).withColumn("extra", F.lit(1))
    for some in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, some, DIR)
            assert found.count() <= 3 * len(ROWS)
            assert name == "best_fit_packing" or found.columns == docs.columns
