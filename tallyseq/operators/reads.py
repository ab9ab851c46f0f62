"""Read pairs: molecule tags cut off before the matched primer, read statistics and their masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def umi_before(seq: Column, match: Column) -> Column:
    """The bases before the first place of the matched primer: none without a match, all where it does not occur."""
    return F.when(F.coalesce(match, F.lit("")) == "", F.lit("")).otherwise(F.split_part(seq, match, F.lit(1)))


def extract_umis(pairs: DataFrame) -> DataFrame:
    """Cut the tags off both mates and note them.

    ``pairs`` has read_id, r1_seq, r1_qual, r2_seq, r2_qual, the matched bases match1 and match2, and the
    adapters' names adapter1 and adapter2. The id gets both tags, the comment both names.
    """
    rows = pairs.withColumns({f"umi{k}": umi_before(F.col(f"r{k}_seq"), F.col(f"match{k}")) for k in (1, 2)})
    rest = lambda k, c: F.substr(f"r{k}_{c}", F.length(f"umi{k}") + 1)
    cut = rows.withColumns({f"r{k}_{c}": rest(k, c) for k in (1, 2) for c in ("seq", "qual")})
    return cut.withColumns({"read_id": F.concat_ws("_", "read_id", "umi1", "umi2"), "comment": F.concat_ws("+", "adapter1", "adapter2")}).drop("match1", "match2", "adapter1", "adapter2")


def read_stats(reads: DataFrame) -> DataFrame:
    """One row per pair from ids ``id_umi_umi`` and comments ``fwd+rev``; other forms raise. Also keeps ``sample``."""
    parts, names = F.split("read_id", "_"), F.split(F.element_at(F.split("comment", " "), -1), r"\+")
    checked = F.when((F.size(parts) == 3) & (F.size(names) == 2), parts).otherwise(F.raise_error(F.concat(F.lit("not an id with two tags and two primers: "), F.col("read_id"), F.lit(" "), F.col("comment"))))
    rows = reads.select("sample", checked.alias("p"), names.alias("n"), F.length("r1_seq").cast("long").alias("r1_length"), F.length("r2_seq").cast("long").alias("r2_length"))
    return rows.select("sample", F.col("p")[0].alias("read_id"), F.col("n")[0].alias("primer_fwd"), F.col("n")[1].alias("primer_rev"), "r1_length", "r2_length", F.col("p")[1].alias("umi5"), F.col("p")[2].alias("umi3"))


def has_primers() -> Column:
    return ~F.col("primer_fwd").isin("no_adapter", "") & ~F.col("primer_rev").isin("no_adapter", "")


def has_good_umis(length: int = 6) -> Column:
    good = lambda c: (F.length(c) == length) & ~F.col(c).contains("N")
    return good("umi5") & good("umi3")


def long_enough(least: int = 60) -> Column:
    return (F.col("r1_length") >= least) & (F.col("r2_length") >= least)


def mask_totals(stats: DataFrame) -> DataFrame:
    """Reads per sample: all, with both primers, with good tags, with both."""
    return stats.groupBy("sample").agg(F.count("*").alias("reads"), F.count_if(has_primers()).alias("with_primers"), F.count_if(has_good_umis()).alias("good_umi"), F.count_if(has_primers() & has_good_umis()).alias("both"))
