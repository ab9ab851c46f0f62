"""Primer panels: subset of a catalog, amplicon regions, order sheets and pools, names of recovered primers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions.sequence import kmers, reverse_complement
from tallyseq.operators.ranks import global_rank
from tallyseq.operators.recover import LINKERS, PREFIXES

#: Fixed value: primers of one ordered pool.
POOL_SIZE = 384


def catalog_subset(targets: DataFrame, transcripts: DataFrame, primer_seqs: DataFrame, primer_info: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transcripts, primer sequences and primer rows of the target genes, each kept by a semi-join with the one before.

    ``targets``: gene. ``transcripts``: gene_symbol, transcript_id, gene_id. ``primer_seqs``: transcript_id,
    transcript_index. ``primer_info``: transcript_index, gene_id. Transcripts stay only if their gene has primers.
    """
    kept = transcripts.join(targets.select(F.col("gene").alias("gene_symbol")), "gene_symbol", "left_semi")
    seqs = primer_seqs.join(kept, "transcript_id", "left_semi")
    info = primer_info.join(seqs, "transcript_index", "left_semi")
    return kept.join(info, "gene_id", "left_semi"), seqs, info


def amplicon_regions(selected: DataFrame, primer_info: DataFrame, sequences: DataFrame) -> DataFrame:
    """Each selected pair with its amplicon or the reason why it has none, in ``status``; nothing is dropped.

    ``selected``: transcript_id, primer_index, l_seq, r_seq. ``primer_info``: amplicon_index, gene_symbol, l_seq, l_start,
    r_seq, r_start (from 1), amplicon_size. ``sequences``: seq_id, seq. The first reason counts: missing_index, seq_mismatch,
    no_transcript, length_mismatch; else ok.
    """
    info = primer_info.select(F.col("amplicon_index").alias("primer_index"), "gene_symbol", F.col("l_seq").alias("own_l"), F.col("r_seq").alias("own_r"), "l_start", "r_start", "amplicon_size", F.lit(True).alias("known"))
    whole = sequences.select(F.col("seq_id").alias("transcript_id"), F.col("seq").alias("whole"))
    rows = selected.join(info, "primer_index", "left").join(whole, "transcript_id", "left")
    region = F.substr("whole", F.col("l_start"), F.greatest(F.col("r_start") - F.col("l_start") + 1, F.lit(0)))
    same = F.col("own_l").eqNullSafe(F.col("l_seq")) & F.col("own_r").eqNullSafe(F.col("r_seq"))
    status = (
        F.when(F.col("known").isNull(), "missing_index")
        .when(~same, "seq_mismatch")
        .when(F.col("whole").isNull(), "no_transcript")
        .when(~F.length(region).eqNullSafe(F.col("amplicon_size")), "length_mismatch")
        .otherwise("ok")
    )
    header = F.concat(F.lit("gene:"), F.col("gene_symbol"), F.lit(" transcript:"), F.col("transcript_id"))
    found = rows.withColumn("status", status)
    ok = lambda c: F.when(F.col("status") == "ok", c)
    return found.select("transcript_id", "primer_index", "status", ok(header).alias("description"), ok(region).alias("region"))


def order_prefix(kind: str, linkers: bool = False) -> str:
    return PREFIXES[kind] + (LINKERS[kind] if linkers else "")


def order_sheet(selection: DataFrame, primer_info: DataFrame, genes: DataFrame, linkers: bool = False) -> DataFrame:
    """One row per selected pair with its gene's group and the sequences to order.

    ``selection``: primer_index. ``primer_info``: amplicon_index, gene_symbol, gene_id, l_seq, r_seq, pool. ``genes``: gene and
    perhaps group (else ``default``); a gene that stands twice raises. Pairs and genes that are not found leave nulls.
    """
    if "group" not in genes.columns:
        genes = genes.withColumn("group", F.lit("default"))
    groups = genes.groupBy(F.col("gene").alias("gene_symbol")).agg(F.max("group").alias("group"), F.count("*").alias("n"))
    groups = groups.select("gene_symbol", F.when(F.col("n") == 1, F.col("group")).otherwise(F.raise_error(F.concat(F.lit("gene stands twice: "), F.col("gene_symbol")))).alias("group"))
    info = primer_info.withColumn("primer_index", F.col("amplicon_index"))
    rows = selection.select("primer_index").join(info, "primer_index", "left").join(groups, "gene_symbol", "left")
    chosen = F.split_part("primer_index", F.lit("_"), F.lit(2)).cast("int")
    order = [F.concat(F.lit(order_prefix(k, linkers)), F.col(c)).alias(n) for k, c, n in (("fwd", "l_seq", "order_forward"), ("rev", "r_seq", "order_reverse"))]
    return rows.select("group", "gene_symbol", "gene_id", chosen.alias("chosen_index"), "amplicon_index", "l_seq", "r_seq", "pool", *order)


#: The order of a sheet's rows.
SHEET_ORDER = ("pool", "group", "gene_symbol", "chosen_index", "amplicon_index")


def ordered_primers(sheet: DataFrame, prefix: str = "pool", size: int = POOL_SIZE) -> DataFrame:
    """Two rows per row of an order sheet, forward before reverse: ``position`` (from 0), ``pool_name``, sequence, gene, direction.

    Pools hold ``size`` primers in the order of the sheet and carry a number only if there are several.
    """
    ranked = global_rank(sheet, *[F.col(c).asc_nulls_last() for c in SHEET_ORDER])
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("sequence"), F.lit(d).alias("direction")) for i, (c, d) in enumerate((("order_forward", "forward"), ("order_reverse", "reverse")))])
    rows = ranked.select("rank", "gene_symbol", F.explode(sides).alias("s")).withColumn("position", 2 * F.col("rank") + F.col("s.side"))
    several = 2 * sheet.count() > size
    name = F.concat(F.lit(f"{prefix}-p"), F.floor(F.col("position") / size) + 1) if several else F.lit(prefix)
    return rows.select("position", name.alias("pool_name"), F.col("s.sequence").alias("sequence"), F.col("gene_symbol").alias("gene"), F.col("s.direction").alias("direction"))


def recovered_orders(pairs: DataFrame, chosen_index: int = 0, linkers: bool = False) -> DataFrame:
    """Grouped pairs as rows of an order: ids without version, sequences to order, and shown with what follows the random bases."""
    fwd, rev = (order_prefix(k, linkers) for k in ("fwd", "rev"))
    plain = lambda c: F.split_part(c, F.lit("."), F.lit(1))
    shown = lambda prefix, c: F.concat(F.lit(prefix.split("NNNNNN", 1)[-1]), F.col(c))
    return pairs.select(
        F.lit("default").alias("group"),
        "gene_symbol",
        plain("gene_id").alias("gene_id"),
        F.lit(chosen_index).alias("chosen_index"),
        F.concat_ws("_", plain("transcript_id"), F.lit(chosen_index)).alias("amplicon_index"),
        shown(fwd, "primer_seq_fwd").alias("l_seq"),
        shown(rev, "primer_seq_rev").alias("r_seq"),
        F.concat(F.lit(fwd), F.col("primer_seq_fwd")).alias("order_forward"),
        F.concat(F.lit(rev), F.col("primer_seq_rev")).alias("order_reverse"),
        F.col("pool_fwd").alias("l_pool"),
        F.col("pool_rev").alias("r_pool"),
        F.col("transcript_id_all").alias("multi_mapping"),
    )


def first_primers(pool: DataFrame) -> DataFrame:
    """Of primers of equal sequence and type the one with the smallest ``ord``."""
    order = Window.partitionBy("primer_seq", "primer_type").orderBy("ord")
    return pool.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def located_primers(locations: DataFrame, pool: DataFrame) -> DataFrame:
    """Locations with the type and pool of their primer; a sequence that is both forward and reverse gives two rows, an unknown one raises."""
    rows = locations.join(pool.select("primer_seq", "primer_type", "pool", F.lit(True).alias("__known")), "primer_seq", "left")
    known = F.coalesce("__known", F.raise_error(F.concat(F.lit("not in the pool: "), F.col("primer_seq"))).cast("boolean"))
    return rows.where(known).drop("__known")


def record_ids(mappings: DataFrame, wanted: DataFrame) -> DataFrame:
    """``seq``, ``record_id``: the sorted distinct symbols of all transcripts that a sequence maps to, joined by a bar.

    ``mappings``: seq, multi_mapping (``transcript|gene|symbol|...`` entries, joined by semicolons). Sequences of
    ``wanted`` (seq) without a mapping come out as ``_NA``; entries of fewer than three fields raise.
    """
    parts = mappings.where("multi_mapping is not null").select("seq", F.explode(F.split("multi_mapping", ";")).alias("entry")).withColumn("fields", F.split("entry", r"\|"))
    symbol = F.when(F.size("fields") >= 3, F.col("fields")[2]).otherwise(F.raise_error(F.concat(F.lit("fewer than three fields: "), F.col("entry"))))
    found = parts.select("seq", symbol.alias("symbol")).distinct().groupBy("seq").agg(F.array_join(F.array_sort(F.collect_list("symbol")), "|").alias("record_id"))
    every = mappings.select("seq").union(wanted.select("seq")).distinct()
    return every.join(found, "seq", "left").select("seq", F.coalesce("record_id", F.lit("_NA")).alias("record_id"))


def tidy_primer(seq: Column) -> Column:
    """Upper case, without white space at the ends or spaces inside."""
    return F.upper(F.replace(F.trim(seq), F.lit(" "), F.lit("")))


def checked_primers(primers: DataFrame) -> DataFrame:
    """Add the tidy ``seq`` and ``valid``: only A, C, G and T, one base at least."""
    return primers.withColumn("seq", tidy_primer(F.col("primer_seq"))).withColumn("valid", F.col("seq").rlike("^[ACGT]+$"))


def complement_words(one: str, two: str, k_min: int, k_max: int) -> Column:
    """Distinct words of column ``one`` whose reverse complement stands in ``two``, as (k, at_one, at_two, word) structs; bounds are checked."""
    if not 0 < k_min <= k_max:
        raise ValueError("0 < k_min <= k_max is needed")
    windows = lambda c, k: kmers(F.col(c), k)

    def met(k: int) -> Column:
        # the words of ``two`` are turned round once and held by the outer lambda: what stands inside one is made again for each element
        other = F.transform(windows(two, k), lambda b: F.struct(b["at"].alias("at"), reverse_complement(b["kmer"]).alias("turned")))
        pairs = lambda a, held: F.transform(F.filter(held, lambda b: b["turned"] == a["kmer"]), lambda b: F.struct(F.lit(k).alias("k"), a["at"].alias("at_one"), b["at"].alias("at_two"), a["kmer"].alias("word")))
        return F.flatten(F.transform(F.array(other), lambda held: F.flatten(F.transform(windows(one, k), lambda a: pairs(a, held)))))

    return F.flatten(F.array(*[met(k) for k in range(k_min, k_max + 1)]))
