"""Tags of alignment records, and the counts that a run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

READ1, READ2, UNMAPPED, NOT_PRIMARY, SECONDARY = 0x40, 0x80, 0x4, 0x900, 0x100
NEW_TAGS = ("cb", "us", "pr", "uc", "xn", "xt", "xf")


def has(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(bits) != 0


def parse_names(rows: DataFrame) -> DataFrame:
    """Split names ``id_umi1_umi2_fwd+rev``; primer names may hold underscores, the reverse one plus signs."""
    parts = F.split("qname", "_", 4)
    pair = F.split(F.get(parts, F.lit(3)), r"\+", 2)
    return rows.withColumns({"read_id": F.get(parts, F.lit(0)), "umi1": F.get(parts, F.lit(1)), "umi2": F.get(parts, F.lit(2)), "primers": F.get(parts, F.lit(3)), "fwd": F.get(pair, F.lit(0)), "rev": F.get(pair, F.lit(1))})


def good_umi() -> Column:
    """Both UMIs have six bases and no N."""
    ok = lambda u: (F.length(u) == 6) & ~F.col(u).contains("N")
    return ok("umi1") & ok("umi2")


def with_adapters() -> Column:
    return (F.col("fwd") != "no_adapter") & (F.col("rev") != "no_adapter")


def demote_repeats(rows: DataFrame) -> DataFrame:
    """Keep the first primary record of each mate of a name (of equal places that of the least gene); later ones become secondary.

    Rows are dealt by sample and name, which also serves the window here and the fold that may follow: one shuffle.
    """
    mate = F.when(has(F.col("flag"), READ1), 1).when(has(F.col("flag"), READ2), 2).otherwise(0)
    primary = ~has(F.col("flag"), NOT_PRIMARY)
    order = Window.partitionBy("sample", "qname", mate, primary).orderBy("ord", *[c for c in ("xt",) if c in rows.columns])
    repeat = primary & (mate > 0) & (F.row_number().over(order) > 1)
    dealt = rows.repartition("sample", "qname")
    return dealt.withColumn("flag", F.when(repeat, F.col("flag").bitwiseOR(SECONDARY)).otherwise(F.col("flag")))


def fold_names(rows: DataFrame) -> DataFrame:
    """One row per name: its gene set over all its records, and what it counts for. Names are taken apart after the fold, once each."""
    flag = F.col("flag")
    r1 = has(flag, READ1) & ~has(flag, NOT_PRIMARY)
    folded = rows.groupBy("sample", "qname").agg(F.collect_set("xt").alias("xts"), F.max(r1).alias("r1"), F.max(r1 & ~has(flag, UNMAPPED)).alias("mapped"))
    every = F.flatten(F.transform("xts", lambda x: F.split(x, ",")))
    genes = F.array_sort(F.array_distinct(F.filter(every, lambda g: (g != "") & (g != "Unassigned"))))
    named = parse_names(folded.withColumn("genes", genes)).select("sample", "qname", "umi1", "umi2", "primers", "fwd", "rev", "genes", "r1", "mapped")
    xf = F.concat_ws(",", F.when(F.size("genes") > 0, F.array_join("genes", ",")).otherwise("Unassigned"), F.col("primers"))
    found = named.withColumns({"xf": xf, "assigned": F.size("genes") > 0, "criteria_ok": good_umi() & with_adapters()})
    return found.withColumn("counted", F.col("mapped") & F.col("criteria_ok"))


def run_totals(names: DataFrame) -> DataFrame:
    """Per sample: what the run's summary line reports."""
    r1 = names.where("r1")
    n = lambda c: F.count_if(c)
    return r1.groupBy("sample").agg(
        F.count("*").alias("total_r1"),
        n(with_adapters()).alias("not_na_adapter"),
        n(good_umi() & with_adapters()).alias("good_umi"),
        n(F.col("mapped")).alias("mapped"),
        n(F.col("assigned")).alias("assigned"),
        n(F.col("counted")).alias("counted"),
        n(F.col("counted") & F.col("assigned")).alias("counted_assigned"),
    )


def record_tags(rows: DataFrame, cell: str | None = "sample", *carried: str) -> DataFrame:
    """Each record with its plain name, flag and tags.

    Repeated primaries of a mate become secondary first, which their flag shows. A primary first mate gets cb (``cell``'s value), us
    (first UMI), pr (primers), uc (both UMIs, if whole and both primers are known) and, where the assigner wrote none, xn = -1 and
    xt = Unassigned, and xf, the genes of all records of its name. Other records keep xt and get no tag. A record that was
    demoted keeps the tags of a first mate but xf. Records are dealt by sample and name once. ``carried`` columns stay as they are.
    """
    before = has(F.col("flag"), READ1) & ~has(F.col("flag"), NOT_PRIMARY)
    marked = demote_repeats(rows.withColumn("tagged", before))
    name = Window.partitionBy("sample", "qname")
    every = F.flatten(F.collect_set(F.split("xt", ",")).over(name))
    genes = F.array_sort(F.array_distinct(F.filter(every, lambda g: (g != "") & (g != "Unassigned"))))
    parsed = parse_names(marked.withColumn("genes", genes))
    on = lambda c: F.when(F.col("tagged"), c)
    xf = F.concat_ws(",", F.when(F.size("genes") > 0, F.array_join("genes", ",")).otherwise("Unassigned"), F.col("primers"))
    return parsed.select(
        "sample",
        "read_id",
        "ord",
        F.col("flag"),
        on(F.col(cell) if cell else F.lit(None).cast("string")).alias("cb"),
        on(F.col("umi1")).alias("us"),
        on(F.col("primers")).alias("pr"),
        on(F.when(good_umi() & with_adapters(), F.concat("umi1", "umi2"))).alias("uc"),
        on(F.when(F.col("xt").isNull(), F.lit(-1))).alias("xn"),
        F.when(F.col("tagged"), F.coalesce("xt", F.lit("Unassigned"))).otherwise(F.col("xt")).alias("xt"),
        F.when(F.col("tagged") & ~has(F.col("flag"), NOT_PRIMARY), xf).alias("xf"),
        *carried,
    )


def tagged_records(records: DataFrame, cell: str | None = None) -> DataFrame:
    """Whole alignment records (``read_alignments``) with their plain names, new flags and new tags, in order ``ord``.

    New tags take the place of old ones of the same name; the other old ones stay. Without ``cell`` no cell is told.
    """
    rest = [c for c in records.columns if c not in ("ord", "qname", "flag")]
    rows = records.withColumns({"sample": F.lit(cell).cast("string"), "xt": F.element_at("tags", "XT")})
    found = record_tags(rows, "sample" if cell else None, *rest)
    new = F.map_filter(F.create_map(*[x for c in NEW_TAGS for x in (F.lit(c.upper()), F.col(c).cast("string"))]), lambda _, v: v.isNotNull())
    kinds = F.transform_values("new", lambda k, _: F.when(k == "XN", "i").otherwise("Z"))
    merge = lambda old, added: F.map_concat(F.map_filter(F.coalesce(old, F.create_map().cast("map<string,string>")), lambda k, _: ~F.map_contains_key("new", k)), added)
    merged = found.withColumn("new", new).withColumns({"tags": merge(F.col("tags"), F.col("new")), "tag_types": merge(F.col("tag_types"), kinds)})
    return merged.withColumnRenamed("read_id", "qname").select(*records.columns).repartitionByRange("ord").sortWithinPartitions("ord")
