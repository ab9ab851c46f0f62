"""Complementary words of several lengths in a pool, against all pairs of windows."""

from collections import Counter

import pytest

from tallyseq.operators import primers
from tallyseq.plans import registry
from tallyseq.session import spread

SEQS = {"a": "TTACGGATCCGTA", "b": "AACGGATC", "c": "GATC", "d": "CCC"}


@pytest.mark.parametrize(("own", "end"), [(True, None), (False, None), (True, 2)])
def test_words_of_four_to_eight_bases(spark, own, end):
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    words = [(i, s[at : at + k], len(s) - at - k) for i, s in SEQS.items() for k in range(4, 9) for at in range(len(s) - k + 1) if end is None or len(s) - at - k <= end]
    want = Counter((i, j, u, d, e) for i, u, d in words for j, v, e in words if u == rc(v) and (i < j or own and i == j))
    found = primers.complement_hits(spark.createDataFrame([*SEQS.items()], "id string, seq string"), include_self=own, most_from_end=end)
    assert Counter((r.id_1, r.id_2, r.kmer, r.d_1, r.d_2) for r in found.collect()) == want and want


def test_frequent_words_are_cut_into_parts(spark, monkeypatch):
    pool = spark.createDataFrame([(f"{i}{s}", seq) for i in range(5) for s, seq in SEQS.items()], "id string, seq string")
    told = lambda: Counter(map(tuple, primers.complement_hits(pool).collect()))
    whole = told()
    monkeypatch.setattr(primers, "TOGETHER", 2)
    assert told() == whole and whole


def test_shuffled_words_grow_with_the_pool(spark, monkeypatch):
    """Chunks of a word are sent to all chunks of its complement, so their number must not follow the places."""
    monkeypatch.setattr(primers, "TOGETHER", 4)
    monkeypatch.setattr(primers, "PIECES", 64, raising=False)
    sent = []

    def watched(df, *keys):
        sent.append(df.count())
        return spread(df, *keys)

    monkeypatch.setattr(primers, "spread", watched)
    pool = spark.createDataFrame([(i, "ACGT") for i in range(400)], "id int, seq string")
    assert primers.complement_hits(pool, 4, 4).count() == 400 * 401 // 2
    assert len(sent) == 2 and 400 < max(sent) <= 400 * 8


@pytest.mark.parametrize("name", ["pattern_locations", "location_checks", "amplicons", "passing_amplicons", "pair_complement_words", "name_audit"])
def test_rows_of_one_row_group_are_dealt(spark, name):
    """Otherwise the task that reads a small table makes everything of it."""
    found = registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
