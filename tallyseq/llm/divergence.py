"""How far the vocabulary of each source lies from that of the others of its language.

Plain relational, all arithmetic exact. The matches of a pattern are exploded once, each occurrence and each first
occurrence in a row of the table, and counted per (lang, source, term) before the shuffle. A language keeps the terms that
stand in enough of its rows. Its groups are crossed with these, which makes the zeros; the grid meets itself on language
and term, and absolute differences of the smoothed shares are summed.

Sizes: the pairs of sources of a language are asked for, so the self-join makes (sources of the language)^2 / 2 rows per
kept term and no more; a key of it holds one row per source. The table of languages and that of groups are broadcast up
to ``BROADCAST_GROUPS`` rows; above that they are joined by a shuffle in which a language is spread over ``SALTS`` keys.

Defined results for odd input: null text, language and source are empty strings; a row without terms still makes its group
known, which then has all kept terms with count 0; a language that keeps no term has value 0 in each pair and no term
rows; equal values rank by item; repeated rows count as often as they stand; texts of any length count whole; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.session import materialize

#: What a term is, the scale of a share, what is added to each count.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000_000
ADDED = 5

MIN_ROWS = 30
TOP = 50
BROADCAST_GROUPS = 50_000
SALTS = 64
#: Counts up to this keep SCALE * (count + ADDED) within 63 bits; larger ones are divided as decimals.
LONG_COUNT = 9_000_000_000


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences ``n`` and rows ``rows`` per (lang, source, term); a group without terms has one row with a null term."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    named = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], F.regexp_extract_all(text, F.lit(TERM), F.lit(0)).alias("terms"))
    twice = named.select("lang", "source", F.posexplode(F.array("terms", F.array_distinct("terms"))).alias("first", "terms"))
    words = twice.select("lang", "source", "first", F.explode_outer("terms").alias("term"))
    held = F.col("term").isNotNull()
    return words.groupBy("lang", "source", "term").agg(F.count_if(held & (F.col("first") == 0)).alias("n"), F.count_if(held & (F.col("first") == 1)).alias("rows"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * kept)), exact at any size."""
    below = total + ADDED * kept
    small = F.lit(SCALE) * (count + ADDED)
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + ADDED).cast("decimal(20,0)")
    return F.when(count <= LONG_COUNT, F.call_function("div", small, below)).otherwise(F.call_function("div", wide, below.cast("decimal(20,0)"))) + 1


def _with_lang(rows: DataFrame, of_lang: DataFrame, size: int) -> DataFrame:
    """Join on ``lang``, of which a few values hold most rows."""
    if size <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(of_lang), "lang")
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)))
    return salted.join(of_lang.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))), ["lang", "__salt"]).drop("__salt")


def audit(docs: DataFrame, min_rows: int = MIN_ROWS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): distances to the other sources and each group's own terms.

    Part ``pair`` has a row for each other source of the language, with the sum of absolute differences of shares over all
    kept terms. Part ``term`` has the ``top`` terms whose share in the group passes that in the language, by difference.
    Rank follows value descending, item ascending.
    """
    counts = materialize(term_counts(docs.select("lang", "source", "text")))
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("rows").alias("rows"), F.sum("n").alias("lang_n")).where(F.col("rows") >= min_rows)
    kept = materialize(kept.select("lang", "term", "lang_n"))
    groups = materialize(counts.select("lang", "source").distinct())
    n_groups = groups.count()
    langs = materialize(kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total")))
    n_langs = langs.count()
    used = counts.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n")
    used = materialize(used)
    totals = groups.join(used.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").fillna(0, ["total"])
    totals = materialize(totals.join(langs, "lang").select("lang", "source", "total", "kept"))
    grid = _with_lang(_with_lang(kept, langs.drop("kept"), n_langs), totals, n_groups)
    cells = grid.join(used, ["lang", "source", "term"], "left").select(
        "lang",
        "source",
        "term",
        F.coalesce("n", F.lit(0)).alias("n"),
        share(F.coalesce("n", F.lit(0)), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    cells = materialize(cells)

    one, other = cells.select("lang", "term", "source", "p"), cells.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("other_p"))
    met = one.join(other, ["lang", "term"]).where("source < item")
    sums = met.groupBy("lang", "source", "item").agg(F.sum(F.abs(F.col("p") - F.col("other_p"))).alias("value"))
    bare = groups.join(langs.select("lang"), "lang", "left_anti")  # languages that keep no term
    sums = sums.unionByName(bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source < item").withColumn("value", F.lit(0).cast("long")))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = sums.select("lang", both.alias("p"), "value").select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value")

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    own = cells.where("n > 0 and p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(own)
