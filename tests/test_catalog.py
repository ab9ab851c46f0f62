"""Every registered query against its SQL, on the small tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tallyseq.plans import registry

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in Path(DIR).iterdir():
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def test_each_query_has_sql():
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"annealed_panel", "batch_corrected_groups"}  # a random search; dispersions by likelihood, tested in test_batches


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    found = registry.queries()[name](spark, DIR)
    names = sorted(found.columns)
    got = db.execute(registry.oracle_sql()[name])
    want_names = [d[0] for d in got.description]
    assert sorted(want_names) == names
    order = [want_names.index(n) for n in names]
    want = Counter(tuple(r[i] for i in order) for r in got.fetchall())
    have = Counter(tuple(r) for r in found.select(*[f"`{n}`" for n in names]).collect())
    assert have == want and have
