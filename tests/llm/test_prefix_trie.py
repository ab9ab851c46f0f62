"""The trie against a brute-force version, with buckets that are parted in rounds and buckets that are sorted at once."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyseq.llm import prefix_trie, queries

DIR = "/root/testdata/sf0.001"
KIND = "conv_id long, turn long, role string, text string"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, says in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + says[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    told = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves = sum(told[k][5] for k in kids[node]) or 1
        ends = ",".join(str(c) for c in members[node] if len(built[c]) == len(node))
        told[node] = (members[node][0], len(node), members[node[:-1]][0] if node else None, len(members[node]), len(kids[node]), leaves, saved + sum(told[k][6] for k in kids[node]), hashlib.sha256(ends.encode()).hexdigest())
    return sorted(told.values(), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*FIELDS).collect()), key=str)


def some_rows():
    dice, rows = random.Random(5), []
    for c in [*range(0, 90, 2), 400, 401, 407, 10**12]:
        for turn in range(dice.choice([1, 1, 2, 4, 6])):
            rows.append((c, turn, dice.choice(["user", "assistant", None]), dice.choice(["yes", "no no", "", None, "a b\tc", "yes"])))
    rows += [(c, None, "user", "first of all") for c in (3, 5)] + [(c, 0, "user", "x") for c in (3, 7, 9)]
    rows += [(c, t, "user", "same long talk") for c in (201, 203, 205, 222, 224) for t in range(9)]
    rows += [(500, t, "user", f"turn {t}") for t in range(300)]
    return rows + [(None, 1, "user", "of no conversation"), (11, 1, None, "w " * 30_000)]


@pytest.mark.parametrize("local", [1, 4, 20, 10**6])
def test_random_talks(spark, local):
    rows = some_rows()
    turns = spark.createDataFrame(rows, KIND).withColumns({"id": F.lit("x"), "pos": F.lit(1), "words": F.lit("y"), "depth": F.lit(2)})
    assert found(prefix_trie.conversation_trie(turns, local)) == brute(rows)


def test_repeated_rows_and_ties(spark):
    rows = [(1, 1, "user", "a"), (1, 1, "user", "a"), (40, 1, "user", "b c"), (40, 1, "user", "b c"), (40, 2, "user", "d")]
    assert found(prefix_trie.conversation_trie(spark.createDataFrame(rows, KIND))) == brute(rows)
    tied = [(c, 1, "user", t) for c in (20, 40) for t in ("a", "b", "c")]
    both = prefix_trie.conversation_trie(spark.createDataFrame(tied, KIND).union(spark.createDataFrame(tied[::-1], KIND)))
    assert both.where("depth = 6").first()["n_convs"] == 2  # one order for equal turns


def test_empty_table(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], KIND)).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op13_prefix_trie(spark, DIR)) == brute(rows)
