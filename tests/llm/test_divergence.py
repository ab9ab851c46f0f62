"""The audit of sources against a brute-force version, also where groups are joined by a shuffle."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyseq.llm import divergence, queries

DIR = "/root/testdata/sf0.001"
KIND = "text string, lang string, source string"
LONG = "zebra apple " * 20_000
ROWS = [
    ("apple Apple pear", "en", "a"),
    ("apple éa pear", "en", "a"),
    ("pear fig 12 -- Ésa", "en", "b"),
    ("pear fig apple", "en", "b"),
    ("pear fig apple", "en", "b"),
    (None, "en", "c"),
    ("", "en", None),
    (LONG, None, "a"),
    ("zebra", None, "a"),
    ("apple zebra", None, ""),
    ("only once", "de", "a"),
    ("another", "de", "b"),
]


def brute(rows, min_rows, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = lambda t: re.findall(divergence.TERM, t.translate(str.maketrans(divergence.UPPER, divergence.LOWER)))
    groups, seen, by_lang = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        groups[lang, source].update(terms(text))
        seen[lang].update(set(terms(text)))
        by_lang[lang].add(source)
    out = []
    for lang, sources in by_lang.items():
        kept = [t for t, n in seen[lang].items() if n >= min_rows]
        shares = {}
        whole = sum((groups[lang, s] for s in sources), Counter())
        for s, count in [*((s, groups[lang, s]) for s in sources), (None, whole)]:
            total = sum(count[t] for t in kept)
            shares[s] = {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}
        for s in sources:
            pairs = [(o, sum(abs(shares[s][t] - shares[o][t]) for t in kept)) for o in sources if o != s]
            own = [(t, shares[s][t] - shares[None][t]) for t in kept if groups[lang, s][t] and shares[s][t] > shares[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", own, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, n) for n, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def told(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("most", [divergence.BROADCAST_GROUPS, 0])
def test_odd_rows(spark, monkeypatch, most):
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", most)
    docs = spark.createDataFrame(ROWS, KIND).withColumns({"term": F.lit("x"), "n": F.lit(1), "value": F.lit("v")})
    for min_rows, top in ((1, 50), (2, 2), (3, 1)):
        assert told(divergence.audit(docs, min_rows, top)) == brute(ROWS, min_rows, top)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], KIND)).count() == 0


def test_shares_of_large_counts(spark):
    row = (30_000_000_000_000, 90_000_000_000_000, 7_000_000)
    found = spark.createDataFrame([row], "n long, total long, kept long").select(divergence.share(F.col("n"), F.col("total"), F.col("kept"))).first()[0]
    assert found == 1 + 1_000_000_000 * (row[0] + 5) // (row[1] + 5 * row[2])


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("text", "lang", "source").collect()]
    assert told(queries.op11_source_divergence(spark, DIR)) == brute(rows, 30, 50)
