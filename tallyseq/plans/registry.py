"""All registered queries of the domain and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyseq.plans import batching, catalog, design, mapping, panel, priming, runs

FLAGSHIP = catalog.FLAGSHIP


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return catalog.queries() | panel.queries() | runs.queries() | design.queries() | batching.queries() | priming.queries() | mapping.queries()


def oracle_sql() -> dict[str, str]:
    return catalog.oracle_sql() | panel.oracle_sql() | runs.oracle_sql() | design.oracle_sql() | batching.oracle_sql() | priming.oracle_sql() | mapping.oracle_sql()
