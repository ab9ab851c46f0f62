"""Registered queries on the assignment of read pairs to a panel of primers, with SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyseq.operators import primer_index, trimming
from tallyseq.sources import views

RATE, OVERLAP = 0.1, 20


def paired_primer_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both mates of all pairs against all primers, with inserted and deleted bases and primers that the read's start cuts."""
    return primer_index.assign_pairs(views.primed_pairs(spark, sf_dir), views.panel(spark, sf_dir, "F"), views.panel(spark, sf_dir, "R"), RATE, OVERLAP)


def trimmed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs without bad tails and adapters."""
    return trimming.trim_pairs(views.quality_pairs(spark, sf_dir), [views.ADAPTERS[0]], [views.ADAPTERS[1]])


def _bases(text: str) -> str:
    return f"translate(md5({text}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def _mate(mate: str, number: int, shift: int) -> str:
    kind, p = f"((o_orderkey + {shift}) % 8)", "coalesce(primer, '')"
    return f"""panel{number} AS (SELECT concat('{mate}', s_suppkey, '_', j) AS adapter, substr({_bases(f"concat('{mate}', s_suppkey, '_', j)")}, 1, 20 + (s_suppkey + j) % 5) AS primer FROM supplier, range({views.PANEL_EACH}) t(j)),
reads{number} AS (
    SELECT o_orderkey AS k, concat(CASE WHEN {kind} = 5 THEN '' ELSE substr({_bases(f"concat('a{number}', o_orderkey)")}, 1, o_custkey % 7) END,
        CASE {kind} WHEN 0 THEN {p} WHEN 1 THEN concat({p}[:9], 'A', {p}[11:]) WHEN 2 THEN concat({p}[:6], {p}[8:]) WHEN 3 THEN concat({p}[:11], 'G', {p}[12:])
            WHEN 4 THEN concat({p}[:4], 'T', {p}[6:14], 'C', {p}[16:]) WHEN 5 THEN {p}[2:] WHEN 6 THEN concat('G', {p}[2:9], 'G', {p}[11:17], 'G', {p}[19:]) ELSE '' END,
        substr({_bases(f"concat('b{number}', o_orderkey)")}, 1, 24)) AS s
    FROM orders LEFT JOIN panel{number} ON adapter = concat('{mate}', (o_orderkey + {shift}) % 100 + 1, '_', o_custkey % {views.PANEL_EACH})
), ends{number} AS (SELECT adapter, length(primer) AS whole, m, right(primer, m) AS p, floor({RATE}::DOUBLE * m + 1e-9)::INT AS e FROM panel{number}, unnest(range({OVERLAP}, length(primer) + 1)) AS t(m)),
pieces{number} AS (SELECT *, i * (m // (e + 1)) AS at, substr(p, i * (m // (e + 1)) + 1, 6) AS word FROM ends{number}, unnest(range(e + 1)) AS t(i)),
spots{number} AS (SELECT DISTINCT k, s, r.at - q.at AS diagonal, adapter, whole, m, p, e FROM (SELECT k, s, x AS at, substr(s, x + 1, 6) AS word FROM reads{number}, unnest(range(length(s) - 5)) AS t(x)) r JOIN pieces{number} q USING (word)),
windows{number} AS (SELECT DISTINCT k, s, adapter, m, p, e, diagonal + d AS start, m + z AS size FROM spots{number}, unnest(range(-e, e + 1)) AS t(d), unnest(range(-e, e + 1)) AS u(z) WHERE diagonal + d >= 0 AND diagonal + d + m + z <= length(s) AND (m = whole OR diagonal + d = 0)),
found{number} AS (SELECT *, substr(s, start + 1, size) AS match, levenshtein(substr(s, start + 1, size), p) AS errors FROM windows{number}),
best{number} AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY errors - m, errors, start, abs(size - m), adapter, size) AS place FROM found{number} WHERE errors <= e)"""


def _trimmed(k: int) -> str:
    adapter, bad = views.ADAPTERS[k - 1], views.BAD.replace("'", "''")
    both = f"translate(concat(md5(concat('i{k}', o_orderkey)), md5(concat('t{k}', o_orderkey))), '{views.BASES[0]}', '{views.BASES[1]}')"
    return f"""raw{k} AS (
    SELECT o_orderkey AS k, 44 - (o_custkey + {k}) % 17 AS good, concat(md5(concat('q{k}', o_orderkey)), md5(concat('r{k}', o_orderkey))) AS marks,
        concat({both}[:20 + o_custkey % 29], CASE (o_orderkey + {k}) % 6 WHEN 0 THEN '' WHEN 1 THEN '{adapter[:3]}A{adapter[4:]}' WHEN 2 THEN '{adapter[:7]}{adapter[8:]}' ELSE '{adapter}' END, {both}[33:])[:48] AS s FROM orders
), scored{k} AS (SELECT k, s, concat(translate(marks[:good], '{views.BASES[0]}', '{views.GOOD}'), translate(marks[good + 1:48], '{views.BASES[0]}', '{bad}'))[:length(s)] AS q FROM raw{k}),
cut{k} AS (
    SELECT k, s[:n] AS s, q[:n] AS q FROM (SELECT *, coalesce(list_max(list_filter(range(4, length(q) + 1), lambda p: ascii(q[p]) + ascii(q[p - 1]) + ascii(q[p - 2]) + ascii(q[p - 3]) - 132 >= 80)), 0) AS n FROM scored{k})
), parts{k} AS (SELECT m, left('{adapter}', m) AS p, floor(0.1::DOUBLE * m + 1e-9)::INT AS e FROM unnest(range(5, {len(adapter) + 1})) AS t(m)),
ends{k} AS (
    SELECT k, s, m, p, e, b, size FROM cut{k}, parts{k}, unnest(range(m - e, m + e + 1)) AS t(size), unnest(range(CASE WHEN m = {len(adapter)} THEN 0 ELSE length(s) - size END, length(s) - size + 1)) AS u(b) WHERE b >= 0
), hits{k} AS (SELECT *, levenshtein(substr(s, b + 1, size), p) AS errors FROM ends{k}),
best{k} AS (SELECT k, b, row_number() OVER (PARTITION BY k ORDER BY errors - m, errors, length(s) - b - size, abs(size - m), size) AS place FROM hits{k} WHERE errors <= e),
told{k} AS (SELECT c.k, s[:coalesce(b, length(s))] AS s, q[:coalesce(b, length(s))] AS q FROM cut{k} c LEFT JOIN best{k} x ON x.k = c.k AND place = 1)"""


_TOLD = ", ".join(f"coalesce(b{n}.adapter, 'no_adapter') AS adapter{n}, coalesce(b{n}.match, '') AS match{n}, b{n}.start::INTEGER AS start{n}, b{n}.errors::INTEGER AS errors{n}" for n in (1, 2))
_SQL = {
    "trimmed_pairs": f"WITH {_trimmed(1)}, {_trimmed(2)} SELECT concat('q', a.k) AS read_id, a.s AS r1_seq, a.q AS r1_qual, b.s AS r2_seq, b.q AS r2_qual FROM told1 a JOIN told2 b USING (k)",
    "paired_primer_assignment": f"""
WITH {_mate("F", 1, 0)}, {_mate("R", 2, 3)}
SELECT concat('q', o_orderkey) AS read_id, {_TOLD} FROM orders LEFT JOIN best1 b1 ON b1.k = o_orderkey AND b1.place = 1 LEFT JOIN best2 b2 ON b2.k = o_orderkey AND b2.place = 1
"""
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (paired_primer_assignment, trimmed_pairs)}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
