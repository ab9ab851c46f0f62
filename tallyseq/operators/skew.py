"""Joins in which a few keys hold many of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are broadcast at most; the limit above which a key counts as hot follows from it.
HOT_KEYS = 20_000
#: Rows of a key that one task always takes.
LEAST_HOT = 64
#: With no more rows than this, all keys are broadcast.
SMALL = 100_000


def hot_limit(total: int, keys: int = HOT_KEYS) -> int:
    """Rows above which a key is hot: of ``total`` rows fewer than ``keys`` keys can hold more than that each."""
    return max(LEAST_HOT, -(-total // keys))


def join_hot(rows: DataFrame, per_key: DataFrame, key: str | list[str], total: int, members: str = "members") -> DataFrame:
    """Inner join of ``rows`` with one row per key, where keys of many rows meet by broadcast.

    ``per_key`` has the number of the key's rows as ``members``, ``total`` is the number of all rows. Hot keys are
    at most ``HOT_KEYS`` by arithmetic, so their broadcast is bounded; the others have few rows each and shuffle.
    """
    limit = hot_limit(total)
    keys = [key] if isinstance(key, str) else key
    if total <= SMALL:
        return rows.join(F.broadcast(per_key), keys)
    hot = per_key.where(F.col(members) > limit)
    cold = per_key.where(F.col(members) <= limit)
    met = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return met.unionByName(rest)
