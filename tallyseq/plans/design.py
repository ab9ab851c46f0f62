"""Registered queries on primer panels and their orders, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.functions.gene_names import audit
from tallyseq.operators import design, primers, recover
from tallyseq.plans import catalog
from tallyseq.session import spread
from tallyseq.sources import views

FWD, REV = (design.order_prefix(k) for k in ("fwd", "rev"))


def _parts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    cut = "translate(md5(cast(p_partkey AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
    return views.table(spark, sf_dir, "part").selectExpr("*", f"{cut} AS cut").selectExpr(*columns)


def _dealt_parts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Parts for queries that make much of each."""
    return spread(_parts(spark, sf_dir, "p_partkey", "cut"), "p_partkey").selectExpr(*columns)


def _subset(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    targets = views.table(spark, sf_dir, "nation").selectExpr("concat('G', n_nationkey) AS gene")
    transcripts = _parts(spark, sf_dir, "concat('T', p_partkey) AS transcript_id", "concat('G', p_partkey % 40) AS gene_symbol", "concat('E', p_partkey % 40) AS gene_id")
    seqs = views.table(spark, sf_dir, "lineitem").selectExpr("concat('T', l_partkey) AS transcript_id", "concat('T', l_partkey, '_', l_suppkey % 4) AS transcript_index").distinct()
    info = _parts(spark, sf_dir, "concat('T', p_partkey, '_', p_size % 4) AS transcript_index", "concat('E', p_partkey % 40 + CASE WHEN p_size % 11 = 0 THEN 100 ELSE 0 END) AS gene_id", "cut AS l_seq")
    return design.catalog_subset(targets, transcripts, seqs, info)


def subset_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subset(spark, sf_dir)[0]


def subset_primer_seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subset(spark, sf_dir)[1]


def subset_primer_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subset(spark, sf_dir)[2]


def amplicon_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = _parts(spark, sf_dir, "concat('T', p_partkey) AS transcript_id", "concat('T', p_partkey, '_0') AS primer_index", "CASE WHEN p_partkey % 19 = 0 THEN 'AAAA' ELSE substring(cut, 1, 14) END AS l_seq", "substring(cut, 15, 14) AS r_seq", "p_partkey AS k")
    info = _parts(
        spark, sf_dir, "concat('T', p_partkey, '_0') AS amplicon_index", "concat('G', p_partkey % 40) AS gene_symbol", "substring(cut, 1, 14) AS l_seq", "substring(cut, 15, 14) AS r_seq",
        "1 + p_partkey % 10 AS l_start", "40 + p_partkey % 20 AS r_start", "40 + p_partkey % 20 - p_partkey % 10 + CASE WHEN p_partkey % 29 = 0 THEN 1 ELSE 0 END AS amplicon_size", "p_partkey AS k",
    )
    seqs = views.sequences(spark, sf_dir).where("seq_id % 23 <> 0").select(F.concat(F.lit("T"), "seq_id").alias("seq_id"), "seq")
    return design.amplicon_regions(selected.drop("k"), info.where("k % 17 <> 0").drop("k"), seqs)


def order_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    selection = _parts(spark, sf_dir, "concat('T', p_partkey, '_', p_size % 4) AS primer_index")
    info = _parts(
        spark, sf_dir, "concat('T', p_partkey, '_', p_size % 4) AS amplicon_index", "concat('G', p_partkey % 30) AS gene_symbol", "concat('E', p_partkey % 30) AS gene_id",
        "substring(cut, 1, 14) AS l_seq", "substring(cut, 15, 14) AS r_seq", "concat('pool', p_partkey % 3) AS pool", "p_partkey AS k",
    ).where("k % 10 <> 0").drop("k")
    genes = views.table(spark, sf_dir, "nation").selectExpr("concat('G', n_nationkey) AS gene", "concat('grp', n_regionkey) AS group")
    return design.order_sheet(selection, info, genes)


def ordered_primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return design.ordered_primers(order_sheet(spark, sf_dir).where("amplicon_index is not null"), "panel")


def pool_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_primers(spark, sf_dir).groupBy("pool_name").agg(F.count("*").alias("n"))


def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_sheet(spark, sf_dir).where("group is not null").groupBy("group").agg(F.count("*").alias("n"))


def recovered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _parts(
        spark, sf_dir, "substring(cut, 1, 14) AS primer_seq_fwd", "substring(cut, 15, 14) AS primer_seq_rev", "concat('T', p_partkey, '.', p_size) AS transcript_id", "concat('E', p_partkey % 40, '.2') AS gene_id",
        "concat('G', p_partkey % 40) AS gene_symbol", "concat('pool', p_partkey % 3) AS pool_fwd", "concat('pool', p_partkey % 3) AS pool_rev", "concat('T', p_partkey, '|E|G', p_partkey % 40) AS transcript_id_all",
    )
    return design.recovered_orders(pairs, 0, linkers=True)


def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "lineitem").where("l_suppkey % 5 <> 0")
    mapped = rows.selectExpr("concat('S', l_suppkey) AS seq", "concat('T', l_partkey, '|E|G', l_partkey % 40, '|x;T', l_orderkey, '|E|G', l_orderkey % 7) AS multi_mapping")
    wanted = views.table(spark, sf_dir, "supplier").selectExpr("concat('S', s_suppkey) AS seq")
    return design.record_ids(mapped, wanted)


def first_primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parts(spark, sf_dir, "substring(cut, 1, 5) AS primer_seq", "CASE WHEN p_size % 2 = 0 THEN 'fwd' ELSE 'rev' END AS primer_type", "concat('pool', p_partkey % 3) AS pool", "p_partkey AS ord")
    return design.first_primers(rows)


def located_primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = first_primers(spark, sf_dir)
    found = _parts(spark, sf_dir, "substring(cut, 1, 5) AS primer_seq", "concat('T', p_partkey) AS transcript_id", "p_size AS start", "p_size + 4 AS end")
    return design.located_primers(found, pool)


def checked_primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return design.checked_primers(_parts(spark, sf_dir, "p_partkey AS primer_id", "concat(' ', lower(substring(cut, 1, 7)), ' ', CASE WHEN p_size % 13 = 0 THEN 'n' ELSE '' END, substring(cut, 8, 7), ' ') AS primer_seq")).drop("primer_seq")


def name_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of up to six names of different kinds; a name is listed if its bit of the key is set."""
    kinds = (
        "concat('Abcd', p_partkey % 9)", "concat('Gm', 100 + p_partkey % 5)", "concat('Abcd', p_partkey % 9, '-Xyz', p_partkey % 4)", "concat('Xyz', p_partkey % 3)", "concat('mt-Co', p_partkey % 2)", "concat('Xyz', p_partkey % 3, 'P', p_partkey % 2)", "concat('Klra', p_partkey % 3)", "concat('Klra', p_partkey % 3, 'b', p_partkey % 2)",
    )
    listed = ", ".join(f"CASE WHEN shiftright(p_partkey, {i}) % 2 = 1 THEN {k} ELSE '' END" for i, k in enumerate(kinds))
    rows = _dealt_parts(spark, sf_dir, "p_partkey AS id", f"array({listed}) AS names")
    return rows.select("id", F.explode(audit(F.col("names"))).alias("d")).select("id", "d.*")


def passing_amplicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover.mark_passing(catalog.amplicons(spark, sf_dir), 20, 40)


def pool_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered pool traced to its pairs: all primers on all transcripts, each in two forms, and the order that they come from."""
    named = views.primers(spark, sf_dir).groupBy("primer_seq").agg(F.min("primer_type").alias("primer_type"), F.min("pair_id").alias("pair_id"))
    pool = named.selectExpr("primer_seq", "primer_type", "concat('p', pair_id % 3) AS pool")  # a sequence that was ordered again belongs to its first pair
    forms = views.sequences(spark, sf_dir).selectExpr("explode(array('a', 'b')) AS form", "seq_id AS p", "seq")
    transcripts = forms.selectExpr("concat('T', p, form, '.1|E', p % 9, '.2|x|y|z|S', p % 9) AS seq_id", "seq")
    kinds = pool.select(F.col("primer_seq").alias("pattern"), "primer_type")
    located = primers.locate(transcripts, kinds.select("pattern")).join(kinds, "pattern")
    found = recover.mark_passing(primers.amplicons(located), 20, 40).where("pass")
    return design.recovered_orders(recover.list_pairs(recover.named_amplicons(found, pool)))


def complement_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complementary places of each primer in the whole pool, words of 4 to 8 bases."""
    pool = views.primers(spark, sf_dir).select(F.concat("pair_id", F.lit("_"), "primer_type").alias("id"), F.col("primer_seq").alias("seq"))
    return primers.complement_loads(pool).select("id", "hits", F.round("load", 4).alias("load"))


def parsed_sequence_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of one to seven fields."""
    fields = ", ".join(f"concat('{name}', p_partkey % {n})" for n, name in zip((97, 40, 7, 5, 3, 11, 2), "TGXYZSK", strict=True))
    rows = _parts(spark, sf_dir, "p_partkey AS id", f"array_join(slice(array({fields}), 1, 1 + cast(p_partkey % 7 AS int)), '|') AS seq_id")
    return rows.select("id", *[c.alias(n) for n, c in recover.split_seq_id(F.col("seq_id")).items()])


def pair_complement_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dealt_parts(spark, sf_dir, "p_partkey AS pair_id", "substring(cut, 1, 14) AS one", "substring(cut, 15, 14) AS two")
    return rows.select("pair_id", F.explode(design.complement_words("one", "two", 4, 8)).alias("w")).select("pair_id", "w.*")


_PARTS = "parts AS (SELECT *, translate(md5(p_partkey::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGT') AS cut FROM part)"
_SUBSET = f"""{_PARTS}, targeted AS (SELECT p_partkey AS k, p_size FROM part WHERE p_partkey % 40 IN (SELECT n_nationkey FROM nation)),
seqs AS (SELECT DISTINCT l_partkey AS k, l_suppkey % 4 AS j FROM lineitem WHERE l_partkey IN (SELECT k FROM targeted)),
info AS (SELECT *, p_partkey % 40 + CASE WHEN p_size % 11 = 0 THEN 100 ELSE 0 END AS g FROM parts WHERE (p_partkey, p_size % 4) IN (SELECT k, j FROM seqs))"""
_SHEET = f"""{_PARTS}, chosen AS (
    SELECT *, p_partkey % 10 <> 0 AS known, 'G' || (p_partkey % 30) AS gs FROM parts
), sheet AS (
    SELECT CASE WHEN known AND n_nationkey IS NOT NULL THEN 'grp' || n_regionkey END AS "group", CASE WHEN known THEN gs END AS gene_symbol, CASE WHEN known THEN 'E' || (p_partkey % 30) END AS gene_id,
        p_size % 4 AS chosen_index, CASE WHEN known THEN concat('T', p_partkey, '_', p_size % 4) END AS amplicon_index,
        CASE WHEN known THEN substr(cut, 1, 14) END AS l_seq, CASE WHEN known THEN substr(cut, 15, 14) END AS r_seq, CASE WHEN known THEN 'pool' || (p_partkey % 3) END AS pool,
        CASE WHEN known THEN '{FWD}' || substr(cut, 1, 14) END AS order_forward, CASE WHEN known THEN '{REV}' || substr(cut, 15, 14) END AS order_reverse
    FROM chosen LEFT JOIN nation ON p_partkey % 30 = n_nationkey
)"""
_ORDERED = f"""{_SHEET}, rows AS (
    SELECT *, row_number() OVER (ORDER BY pool NULLS LAST, "group" NULLS LAST, gene_symbol NULLS LAST, chosen_index, amplicon_index) - 1 AS r, count(*) OVER () AS n FROM sheet WHERE amplicon_index IS NOT NULL
), sides AS (
    SELECT 2 * r AS position, n, order_forward AS sequence, gene_symbol AS gene, 'forward' AS direction FROM rows UNION ALL SELECT 2 * r + 1, n, order_reverse, gene_symbol, 'reverse' FROM rows
), ordered AS (
    SELECT position, CASE WHEN 2 * n > 384 THEN concat('panel-p', position // 384 + 1) ELSE 'panel' END AS pool_name, sequence, gene, direction FROM sides
)"""

_SQL = {
    "pool_orders": f"""
WITH {catalog._SEQ}, {catalog._POOL}, forms AS (SELECT id, form, seq FROM seqs, (VALUES ('a'), ('b')) f(form)),
spots AS (SELECT id, form, pos, substr(seq, pos, 14) AS word FROM forms, unnest(range(1, 52)) AS t(pos)),
kinds AS (SELECT seq AS pattern, min(primer_type) AS kind, min(pair_id) AS pair_id FROM pool GROUP BY seq),
ups AS (SELECT s.*, pattern, pair_id FROM spots s JOIN kinds ON word = pattern AND kind = 'fwd'), downs AS (SELECT s.*, pattern, pair_id FROM spots s JOIN kinds ON word = {catalog._RC.format("pattern")} AND kind = 'rev'),
met AS (
    SELECT u.id, u.form, u.pattern AS fwd, d.pattern AS rev, u.pos AS us, d.pos AS ds, d.pos + 13 - u.pos + 1 AS len, u.pair_id % 3 AS up, d.pair_id % 3 AS dp, concat('E', u.id % 9, '.2') AS gene, concat('T', u.id, u.form, '.1') AS t
    FROM ups u JOIN downs d ON u.id = d.id AND u.form = d.form AND u.pos + 13 < d.pos AND d.pos + 13 - u.pos + 1 BETWEEN 20 AND 40
), told AS (SELECT *, concat_ws('|', t, gene, concat('S', id % 9), us, us + 13, ds, ds + 13, len) AS one FROM met)
SELECT 'default' AS "group", arg_min(concat('S', id % 9), (gene, t, us, ds)) AS gene_symbol, split_part(min(gene), '.', 1) AS gene_id, 0 AS chosen_index, concat(split_part(arg_min(t, (gene, t, us, ds)), '.', 1), '_0') AS amplicon_index,
    fwd AS l_seq, rev AS r_seq, '{FWD}' || fwd AS order_forward, '{REV}' || rev AS order_reverse, 'p' || min(up) AS l_pool, 'p' || min(dp) AS r_pool, string_agg(one, ';' ORDER BY gene, t, us, ds) AS multi_mapping
FROM told GROUP BY fwd, rev
""",
    "complement_loads": f"""
WITH {catalog._POOL}, w AS (SELECT concat(pair_id, '_', primer_type) AS id, substr(seq, (length(seq) - d - k + 1)::INT, k::INT) AS kmer, d::INT AS d FROM pool, range(4, 9) r(k), range(0, 60) q(d) WHERE d + k <= length(seq))
SELECT a.id, count(*) AS hits, round(sum({catalog._SCORE.format("a.kmer")} / ((1 + a.d) * (1 + b.d))), 4) AS load FROM w a JOIN w b ON a.kmer = {catalog._RC.format("b.kmer")} GROUP BY a.id
""",
    "subset_transcripts": f"WITH {_SUBSET} SELECT 'T' || k AS transcript_id, 'G' || (k % 40) AS gene_symbol, 'E' || (k % 40) AS gene_id FROM targeted WHERE k % 40 IN (SELECT g FROM info)",
    "subset_primer_seqs": f"WITH {_SUBSET} SELECT 'T' || k AS transcript_id, concat('T', k, '_', j) AS transcript_index FROM seqs",
    "subset_primer_info": f"WITH {_SUBSET} SELECT concat('T', p_partkey, '_', p_size % 4) AS transcript_index, 'E' || g AS gene_id, cut AS l_seq FROM info",
    "amplicon_regions": f"""
WITH {_PARTS}, judged AS (
    SELECT *, CASE WHEN p_partkey % 17 = 0 THEN 'missing_index' WHEN p_partkey % 19 = 0 THEN 'seq_mismatch' WHEN p_partkey % 23 = 0 THEN 'no_transcript' WHEN p_partkey % 29 = 0 THEN 'length_mismatch' ELSE 'ok' END AS status,
        translate(concat(md5(p_partkey::VARCHAR), md5(concat('x', p_partkey))), '0123456789abcdef', 'ACGTACGTACGTACGT') AS whole
    FROM parts
)
SELECT 'T' || p_partkey AS transcript_id, 'T' || p_partkey || '_0' AS primer_index, status,
    CASE WHEN status = 'ok' THEN concat('gene:G', p_partkey % 40, ' transcript:T', p_partkey) END AS description, CASE WHEN status = 'ok' THEN whole[1 + p_partkey % 10 : 40 + p_partkey % 20] END AS region
FROM judged
""",
    "order_sheet": f"WITH {_SHEET} SELECT * FROM sheet",
    "ordered_primers": f"WITH {_ORDERED} SELECT * FROM ordered",
    "pool_sizes": f"WITH {_ORDERED} SELECT pool_name, count(*) AS n FROM ordered GROUP BY pool_name",
    "group_sizes": f'WITH {_SHEET} SELECT "group", count(*) AS n FROM sheet WHERE "group" IS NOT NULL GROUP BY "group"',
    "recovered_orders": f"""
WITH {_PARTS} SELECT 'default' AS "group", 'G' || (p_partkey % 40) AS gene_symbol, 'E' || (p_partkey % 40) AS gene_id, 0 AS chosen_index, concat('T', p_partkey, '_0') AS amplicon_index,
    'ACATCA' || substr(cut, 1, 14) AS l_seq, 'ATAGTT' || substr(cut, 15, 14) AS r_seq, '{FWD}ACATCA' || substr(cut, 1, 14) AS order_forward, '{REV}ATAGTT' || substr(cut, 15, 14) AS order_reverse,
    'pool' || (p_partkey % 3) AS l_pool, 'pool' || (p_partkey % 3) AS r_pool, concat('T', p_partkey, '|E|G', p_partkey % 40) AS multi_mapping FROM parts
""",
    "record_ids": """
WITH symbols AS (SELECT l_suppkey AS s, 'G' || (l_partkey % 40) AS g FROM lineitem WHERE l_suppkey % 5 <> 0 UNION SELECT l_suppkey, 'G' || (l_orderkey % 7) FROM lineitem WHERE l_suppkey % 5 <> 0)
SELECT 'S' || k AS seq, coalesce(string_agg(g, '|' ORDER BY g), '_NA') AS record_id FROM (SELECT s_suppkey AS k FROM supplier UNION SELECT s FROM symbols) LEFT JOIN symbols ON s = k GROUP BY k
""",
    "first_primers": f"""
WITH {_PARTS} SELECT substr(cut, 1, 5) AS primer_seq, CASE WHEN p_size % 2 = 0 THEN 'fwd' ELSE 'rev' END AS primer_type, 'pool' || (min(p_partkey) % 3) AS pool, min(p_partkey) AS ord FROM parts GROUP BY 1, 2
""",
    "located_primers": f"""
WITH {_PARTS}, pool AS (SELECT substr(cut, 1, 5) AS primer_seq, CASE WHEN p_size % 2 = 0 THEN 'fwd' ELSE 'rev' END AS primer_type, 'pool' || (min(p_partkey) % 3) AS pool FROM parts GROUP BY 1, 2)
SELECT primer_seq, 'T' || p_partkey AS transcript_id, p_size AS start, p_size + 4 AS "end", primer_type, pool FROM parts JOIN pool ON primer_seq = substr(cut, 1, 5)
""",
    "checked_primers": f"WITH {_PARTS} SELECT p_partkey AS primer_id, substr(cut, 1, 7) || CASE WHEN p_size % 13 = 0 THEN 'N' ELSE '' END || substr(cut, 8, 7) AS seq, p_size % 13 <> 0 AS valid FROM parts",
    "passing_amplicons": f"SELECT *, length BETWEEN 20 AND 40 AND up_type = 'fwd' AND down_type = 'rev' AS pass FROM ({catalog.oracle_sql()['amplicons']})",
    "parsed_sequence_ids": """
SELECT p_partkey AS id, concat('T', p_partkey % 97) AS transcript_id, CASE WHEN p_partkey % 7 >= 1 THEN concat('G', p_partkey % 40) ELSE '_NA' END AS gene_id,
    CASE WHEN p_partkey % 7 >= 5 THEN concat('S', p_partkey % 11) ELSE concat('T', p_partkey % 97) END AS gene_symbol FROM part
""",
    "name_audit": """
WITH kinds AS (
    SELECT p_partkey AS id, p_partkey % 3 AS m, [x FOR x, i IN [concat('Abcd', p_partkey % 9), concat('Gm', 100 + p_partkey % 5), concat('Abcd', p_partkey % 9, '-Xyz', p_partkey % 4), concat('Xyz', p_partkey % 3),
        concat('mt-Co', p_partkey % 2), concat('Xyz', p_partkey % 3, 'P', p_partkey % 2), concat('Klra', p_partkey % 3), concat('Klra', p_partkey % 3, 'b', p_partkey % 2)] IF (p_partkey >> (i - 1)) % 2 = 1] AS l
    FROM part
), each AS (
    SELECT id, l, unnest(l) AS name, len(list_filter(l, lambda x: NOT regexp_full_match(x, 'Gm[0-9]+|Xyz[0-9]P[0-9]|Klra[0-9]b[0-9]'))) > 0 AS real FROM kinds
)
SELECT id, name, CASE WHEN contains(name, '-X') THEN 'dropped: readthrough_component_present' WHEN real THEN 'dropped: pseudo_like_with_real_symbols_present' END AS reason
FROM each WHERE CASE WHEN contains(name, '-X') THEN list_contains(l, string_split(name, '-')[1]) OR list_contains(l, string_split(name, '-')[2])
    ELSE real AND regexp_full_match(name, 'Gm[0-9]+|Xyz[0-9]P[0-9]|Klra[0-9]b[0-9]') END
""",
    "pair_complement_words": f"""
WITH {_PARTS}, one AS (SELECT p_partkey AS pair_id, k, i AS at_one, substr(substr(cut, 1, 14), i + 1, k) AS word FROM parts, range(4, 9) a(k), range(0, 11) b(i) WHERE i + k <= 14),
two AS (SELECT p_partkey AS pair_id, k, i AS at_two, reverse(translate(substr(substr(cut, 15, 14), i + 1, k), 'ACGT', 'TGCA')) AS word FROM parts, range(4, 9) a(k), range(0, 11) b(i) WHERE i + k <= 14)
SELECT pair_id, k::INT AS k, at_one::INT AS at_one, at_two::INT AS at_two, word FROM one JOIN two USING (pair_id, k, word)
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        pool_orders,
        complement_loads,
        subset_transcripts,
        subset_primer_seqs,
        subset_primer_info,
        amplicon_regions,
        order_sheet,
        ordered_primers,
        pool_sizes,
        group_sizes,
        recovered_orders,
        record_ids,
        first_primers,
        located_primers,
        checked_primers,
        name_audit,
        parsed_sequence_ids,
        passing_amplicons,
        pair_complement_words,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
