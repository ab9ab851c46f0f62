"""Pools recovered from an order: primer classes, amplicon groups, location checks, candidates by gene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions.sequence import kmers, reverse_complement
from tallyseq.session import spread

#: Patterns up to this number are sent to all tasks.
MOST_SENT = 200_000
#: The universal prefixes of forward and reverse primers, with their random bases.
PREFIXES = {"fwd": "CCTACACGACGCTCTTCCGATCTNNNNNN", "rev": "TCAGACGTGTGCTCTTCCGATCTNNNNNN"}
#: The optional linkers after the prefixes.
LINKERS = {"fwd": "ACATCA", "rev": "ATAGTT"}


def classify(order: DataFrame, linkers: bool = True) -> DataFrame:
    """Add ``primer_type`` and ``primer_seq`` (what follows the prefix) to ``pool``, ``sequence``; an unknown prefix raises."""
    start = {k: p + (LINKERS[k] if linkers else "") for k, p in PREFIXES.items()}
    kind = F.lit(None).cast("string")
    for k in ("rev", "fwd"):
        kind = F.when(F.col("sequence").startswith(start[k]), F.lit(k)).otherwise(kind)
    rows = order.withColumn("primer_type", F.coalesce(kind, F.raise_error(F.concat(F.lit("no known prefix: pool "), F.col("pool"), F.lit(", "), F.col("sequence"))).cast("string")))
    return rows.withColumn("primer_seq", F.substr("sequence", F.when(F.col("primer_type") == "fwd", len(start["fwd"]) + 1).otherwise(len(start["rev"]) + 1)))


def split_seq_id(seq_id: Column) -> dict[str, Column]:
    """Transcript, gene (``_NA`` if absent) and symbol (the transcript if absent) of a bar-joined id."""
    parts = F.split(seq_id, r"\|")
    return {"transcript_id": parts[0], "gene_id": F.coalesce(F.get(parts, F.lit(1)), F.lit("_NA")), "gene_symbol": F.coalesce(F.get(parts, F.lit(5)), parts[0])}


def length_passes(length: Column, low: int = -1, high: int = -1) -> Column:
    """Inclusive bounds; -1 leaves a side open."""
    return (F.lit(low == -1) | (length >= low)) & (F.lit(high == -1) | (length <= high))


def mark_passing(amplicons: DataFrame, low: int = -1, high: int = -1) -> DataFrame:
    """Add ``pass``: the length lies within the bounds and a forward primer faces a reverse one. Nothing is dropped."""
    facing = (F.col("up_type") == "fwd") & (F.col("down_type") == "rev")
    return amplicons.withColumn("pass", length_passes(F.col("length"), low, high) & facing)


def group_pairs(amplicons: DataFrame) -> DataFrame:
    """One row per (fwd, rev): the first amplicon by gene and transcript, counts, and all transcripts.

    ``amplicons`` has fwd, rev, gene_id, transcript_id, start, end. The listing of a group is an
    aggregate of distinct names: repeated places do not lengthen it. Amplicons are dealt by pair once; the
    aggregate finds its rows in place, and numbers of names come from the sets.
    """
    return _groups(spread(amplicons.select("fwd", "rev", "gene_id", "transcript_id", "start", "end"), "fwd", "rev"))


def group_facing(transcripts: DataFrame, patterns: DataFrame, gene: Column, transcript: Column) -> DataFrame:
    """``group_pairs`` of all amplicons that ``patterns`` (pattern) have on ``transcripts`` (seq_id, seq), where places are dense and transcripts short.

    A place of the plus strand is dealt by its pattern with the bases behind it; the places that face it are found there, so a shuffle has a row per
    place and not per amplicon. Places are those of ``primers.locate``. ``gene`` and ``transcript`` are made of ``seq_id`` behind the shuffle.
    """
    wanted = patterns.select(F.upper("pattern").alias("pattern")).distinct()
    sizes = sorted(r[0] for r in wanted.select(F.length("pattern")).distinct().collect())
    sent = F.broadcast if wanted.count() <= MOST_SENT else lambda df: df
    windows = lambda seq: F.explode(F.flatten(F.array(*[kmers(F.col(seq), k) for k in sizes])) if sizes else F.array().cast("array<struct<at:int,kmer:string>>")).alias("w")
    spots = transcripts.select("seq_id", F.upper("seq").alias("seq")).select("seq_id", "seq", windows("seq"))
    behind = F.substr("seq", F.col("w.at") + F.length("w.kmer") + 1)
    ups = spots.select("seq_id", F.col("w.kmer").alias("fwd"), (F.col("w.at") + 1).alias("start"), behind.alias("rest")).where(F.length("rest") >= min(sizes, default=0))
    ups = ups.join(sent(wanted.select(F.col("pattern").alias("fwd"))), "fwd")
    bases = ups.agg(F.sum(F.length("rest"))).first()[0] or 0  # no fewer than amplicons, for one length of patterns
    facing = spread(ups, "fwd", rows=bases).select("seq_id", "fwd", "start", windows("rest"))
    facing = facing.select("seq_id", "fwd", "start", (F.col("start") + F.length("fwd") + F.col("w.at") + F.length("w.kmer") - 1).alias("end"), F.col("w.kmer").alias("word"))
    found = facing.join(sent(wanted.select(F.col("pattern").alias("rev"), reverse_complement(F.col("pattern")).alias("word"))), "word")
    return _groups(found.select("fwd", "rev", gene.alias("gene_id"), transcript.alias("transcript_id"), "start", "end"))


def _groups(amplicons: DataFrame) -> DataFrame:
    number = lambda c: F.size(F.collect_set(c)).cast("long")
    first = F.min(F.struct("gene_id", "transcript_id", "start", "end"))
    found = amplicons.groupBy("fwd", "rev").agg(first.alias("first"), number("transcript_id").alias("num_transcripts"), number("gene_id").alias("num_genes"), F.count("*").alias("num_amplicons"), F.array_join(F.array_sort(F.collect_set("transcript_id")), ";").alias("transcript_id_all"))
    return found.select("fwd", "rev", "first.*", "num_transcripts", "num_genes", "num_amplicons", "transcript_id_all")


#: The fields of an amplicon in a pair's listing.
LISTED = ("transcript_id", "gene_id", "gene_symbol", "start_up", "end_up", "start_down", "end_down", "amplicon_length")


def named_amplicons(amplicons: DataFrame, primers: DataFrame) -> DataFrame:
    """Amplicons of ``primers.amplicons`` with the names that ``list_pairs`` wants: fields of the sequence id, and the pools of both primers.

    ``primers``: primer_seq, primer_type, pool. A primer of several pools gives rows for each, which ``list_pairs`` refuses.
    """
    ids = split_seq_id(F.col("seq_id"))
    rows = amplicons.select(
        F.col("up").alias("primer_seq_fwd"), F.col("down").alias("primer_seq_rev"), *[c.alias(n) for n, c in ids.items()],
        F.col("up_start").alias("start_up"), F.col("up_end").alias("end_up"), F.col("down_start").alias("start_down"), F.col("down_end").alias("end_down"), F.col("length").alias("amplicon_length"),
    )
    pool = lambda kind: primers.where(F.col("primer_type") == kind).select(F.upper("primer_seq").alias(f"primer_seq_{kind}"), F.col("pool").alias(f"pool_{kind}")).distinct()
    return rows.join(pool("fwd"), "primer_seq_fwd").join(pool("rev"), "primer_seq_rev")


def list_pairs(amplicons: DataFrame) -> DataFrame:
    """One row per primer pair, as ``design.recovered_orders`` takes it: its first amplicon by gene and transcript, counts and the listing.

    The listing has the eight ``LISTED`` fields of each amplicon, bar-joined, in order of gene, transcript and place; its length follows the
    pair's amplicons, by its form. A pair whose primer is of several pools raises. An empty table gives an empty result.
    """
    keys = ["primer_seq_fwd", "primer_seq_rev"]
    rank = F.struct("gene_id", "transcript_id", "start_up", "end_up", "start_down", "end_down", "gene_symbol", F.concat_ws("|", *[F.col(c).cast("string") for c in LISTED]).alias("told"))
    one_pool = lambda side: F.when(F.min(f"pool_{side}").eqNullSafe(F.max(f"pool_{side}")), F.min(f"pool_{side}")).otherwise(F.raise_error(F.concat(F.lit(f"several pools of {side}: "), F.col(f"primer_seq_{side}"))).cast("string"))
    found = amplicons.groupBy(*keys).agg(
        F.array_sort(F.collect_list(rank)).alias("all"), one_pool("fwd").alias("pool_fwd"), one_pool("rev").alias("pool_rev"),
        F.count_distinct("transcript_id").alias("num_transcripts"), F.count_distinct("gene_id").alias("num_genes"),
    )
    first = [F.col("all")[0][c].alias(c) for c in ("transcript_id", "gene_id", "gene_symbol", "start_up", "end_up", "start_down", "end_down")]
    return found.select(*keys, *first, "pool_fwd", "pool_rev", "num_transcripts", "num_genes", F.array_join(F.transform("all", lambda a: a["told"]), ";").alias("transcript_id_all"))


def location_checks(located: DataFrame) -> DataFrame:
    """Per pattern: places, transcripts, and transcripts that hold it more than once."""
    each = located.groupBy("pattern", "seq_id").agg(F.count("*").alias("n"))
    return each.groupBy("pattern").agg(F.sum("n").alias("places"), F.count("*").alias("transcripts"), F.count_if(F.col("n") > 1).alias("repeated_in"))


def match_candidates(wanted: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates of the wanted genes; where a gene names primers, only those that match them.

    ``wanted``: gene, primer_fwd, primer_rev (null: any). ``candidates``: gene, amplicon_index, l_seq, r_seq.
    """
    w, c = wanted.alias("w"), candidates.alias("c")
    fits = lambda a, b: F.col(a).isNull() | (F.col(a) == F.col(b))
    on = (F.col("w.gene") == F.col("c.gene")) & fits("w.primer_fwd", "c.l_seq") & fits("w.primer_rev", "c.r_seq")
    return c.join(w, on, "left_semi")


def missing_genes(wanted: DataFrame, candidates: DataFrame) -> DataFrame:
    """Wanted rows that no candidate fits."""
    w, c = wanted.alias("w"), candidates.alias("c")
    fits = lambda a, b: F.col(a).isNull() | (F.col(a) == F.col(b))
    return w.join(c, (F.col("w.gene") == F.col("c.gene")) & fits("w.primer_fwd", "c.l_seq") & fits("w.primer_rev", "c.r_seq"), "left_anti")


def sanity_report(pool: DataFrame, located: DataFrame, amplicons: DataFrame) -> DataFrame:
    """(check, n): how many keys break each expectation of a recovered pool; 0 everywhere is clean.

    ``pool``: primer_seq, primer_type, pool. ``located``: pattern, seq_id, gene_id, start, end.
    ``amplicons``: fwd, rev, gene_id, pool_fwd, pool_rev.
    """
    count = lambda df, keys, what: df.groupBy(*keys).agg(what.alias("__n")).where("__n > 1").agg(F.count("*").alias("n"))
    checks = {
        "primers ordered twice": count(pool, ["primer_seq"], F.count("*")),
        "primers ordered twice as one type": count(pool, ["primer_seq", "primer_type"], F.count("*")),
        "patterns with several places": count(located, ["pattern"], F.count("*")),
        "patterns with several places in one transcript": count(located, ["pattern", "seq_id"], F.count("*")),
        "patterns in several genes": count(located, ["pattern"], F.count_distinct("gene_id")),
        "places of another length than their pattern": located.where(F.col("end") - F.col("start") + 1 != F.length("pattern")).agg(F.count("*").alias("n")),
        "pairs in several genes": count(amplicons, ["fwd", "rev"], F.count_distinct("gene_id")),
        "pairs with several amplicons": count(amplicons, ["fwd", "rev"], F.count("*")),
        "pairs across pools": amplicons.where("pool_fwd <> pool_rev").select("fwd", "rev").distinct().agg(F.count("*").alias("n")),
        "primers in several pairs": count(amplicons.select("fwd", "rev").distinct().unpivot([], ["fwd", "rev"], "side", "primer"), ["primer"], F.count("*")),
    }
    out = None
    for name, df in checks.items():
        row = df.select(F.lit(name).alias("check"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def distinct_record_ids(records: DataFrame) -> DataFrame:
    """Add ``.1``, ``.2`` ... to equal ``record_id`` values, in ascending order of ``seq``."""
    place = F.row_number().over(Window.partitionBy("record_id").orderBy("seq")) - 1
    return records.withColumn("record_id", F.concat("record_id", F.when(place > 0, F.concat(F.lit("."), place)).otherwise(F.lit(""))))
