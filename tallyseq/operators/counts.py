"""From grouped reads to counts, in long form: (sample, feature, n)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions.sequence import features_of
from tallyseq.operators.graph import connected_components
from tallyseq.session import materialize, spread


#: Samples or features up to this number are broadcast.
SHORT = 50_000


def assigned(groups: DataFrame) -> DataFrame:
    """Reads whose gene is not the unassigned placeholder; the comma belongs to the test."""
    return groups.where(~F.col("gene").startswith("Unassigned,"))


def raw_counts(groups: DataFrame) -> DataFrame:
    """Reads per sample and feature."""
    return assigned(groups).groupBy("sample", features_of(F.col("gene")).alias("feature")).agg(F.count("*").alias("n"))


def molecule_counts(groups: DataFrame) -> DataFrame:
    """Distinct molecules: (gene, final_umi) per sample, summed to features; a null UMI is one value."""
    distinct = assigned(groups).select("sample", "gene", "final_umi").distinct()
    return distinct.groupBy("sample", features_of(F.col("gene")).alias("feature")).agg(F.count("*").alias("n"))


def group_umis(reads: DataFrame) -> DataFrame:
    """Group reads by (sample, gene, umi) where all are known: adds ``umi_count`` and a ``unique_id`` hash of the group."""
    key = ["sample", "gene", "umi"]
    dealt = reads.dropna(subset=key).repartition(*key)  # the one shuffle: the count and the join find their rows in place
    sizes = dealt.groupBy(*key).agg(F.count("*").alias("umi_count"))
    return dealt.join(sizes.hint("merge"), key).withColumn("unique_id", F.xxhash64(*key))


def complete(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """The dense sample x feature grid with zeros, also for samples without any count; the shorter side is broadcast if it is short."""
    rows, columns = samples.select("sample").distinct(), counts.select("feature").distinct()
    n_rows, n_columns = rows.count(), columns.count()
    if min(n_rows, n_columns) <= SHORT:
        grid = rows.crossJoin(F.broadcast(columns)) if n_columns <= n_rows else columns.crossJoin(F.broadcast(rows))
    else:
        grid = rows.crossJoin(columns)
    return grid.join(counts, ["sample", "feature"], "left").select("sample", "feature", "n").fillna(0, subset=["n"])


def mean_abundance(counts: DataFrame) -> DataFrame:
    """Features by mean relative abundance over the samples that have any count; holes count as zero."""
    totals = counts.groupBy("sample").agg(F.sum("n").alias("total")).where("total > 0")
    shares = counts.join(totals, "sample").groupBy("feature").agg(F.sum(F.col("n") / F.col("total")).alias("shares"))
    return shares.crossJoin(totals.agg(F.count("*").alias("samples"))).select("feature", (F.col("shares") / F.col("samples")).alias("abundance"))


def _names(gene: Column) -> Column:
    """The names of a composite gene, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(gene, ","), lambda g: F.trim(g)), lambda g: g != "")


def _by_read(rows: DataFrame) -> DataFrame:
    """Rows dealt by (sample, read_id) before anything is grouped: reads hardly repeat, so sums on both sides of a shuffle hold them twice."""
    return spread(rows, "sample", "read_id", rows=rows.count())


def consolidate_reads(groups: DataFrame) -> DataFrame:
    """One row per (sample, read): its sorted distinct genes."""
    rows = _by_read(groups.select("sample", "read_id", "gene"))
    named = rows.groupBy("sample", "read_id").agg(F.array_join(F.collect_list("gene"), ",").alias("gene"))
    return named.select("sample", "read_id", F.array_sort(F.array_distinct(_names(F.col("gene")))).alias("genes")).where(F.size("genes") > 0)


def cooccurrence(reads: DataFrame) -> DataFrame:
    """Reads per unordered pair of genes, without a self-join: pairs come from each read's own sorted list."""
    pairs = F.flatten(F.transform("genes", lambda a, i: F.transform(F.slice("genes", i + 2, F.size("genes")), lambda b: F.struct(a.alias("gene_a"), b.alias("gene_b")))))
    return reads.select(F.explode(pairs).alias("p")).groupBy("p.gene_a", "p.gene_b").agg(F.count("*").alias("weight"))


def gene_components(edges: DataFrame) -> DataFrame:
    """(gene, component): the component is named by its sorted genes, joined by a bar."""
    parts = connected_components(edges.select("gene_a", "gene_b"))
    names = parts.groupBy("component").agg(F.array_join(F.array_sort(F.collect_set("node")), "|").alias("name"))
    return parts.join(names, "component").select(F.col("node").alias("gene"), F.col("name").alias("component"))


def collapse_symbols(counts: DataFrame, symbols: DataFrame) -> DataFrame:
    """Mean over the features of one symbol, zero cells included, rounded half to even."""
    named = counts.join(symbols, "feature", "left").withColumn("symbol", F.coalesce("symbol", "feature"))
    width = counts.select("feature").distinct().join(symbols, "feature", "left").groupBy(F.coalesce("symbol", "feature").alias("symbol")).agg(F.count("*").alias("columns"))
    return named.groupBy("sample", "symbol").agg(F.sum("n").alias("n")).join(width, "symbol").select("sample", "symbol", F.bround(F.col("n") / F.col("columns"), 0).cast("long").alias("n"))


def log2_cpm(counts: DataFrame, prior: float = 1.0) -> DataFrame:
    """log2(prior + n / depth * total), with the mean depth as total where that is below a million."""
    depth = counts.groupBy("sample").agg(F.sum("n").alias("depth"))
    total = depth.agg(F.least(F.avg("depth"), F.lit(1e6)).alias("total"))
    return counts.join(depth, "sample").crossJoin(F.broadcast(total)).select("sample", "feature", F.log2(F.lit(prior) + F.col("n") / F.col("depth") * F.col("total")).alias("value"))


def reads_per_gene(groups: DataFrame) -> DataFrame:
    """All reads per composite gene, the unassigned too."""
    return groups.groupBy("sample", "gene").agg(F.count("*").alias("n"))


def reads_per_umi(groups: DataFrame) -> DataFrame:
    """Reads per gene and molecule tag."""
    return groups.groupBy("sample", F.concat_ws(":", "gene", "final_umi").alias("gene_umi")).agg(F.count("*").alias("n"))


def component_counts(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """Distinct molecule tags per sample and component of genes; a gene of no component stands for itself."""
    genes = groups.select("sample", "final_umi", F.explode(F.split("gene", ",")).alias("gene"))
    named = genes.join(parts, "gene", "left").select("sample", F.coalesce("component", "gene").alias("component"), "final_umi").distinct()
    return named.groupBy("sample", "component").agg(F.count("*").alias("n"))


def read_components(reads: DataFrame, parts: DataFrame) -> DataFrame:
    """One component per read (sample, read_id, genes): that of its first gene; a gene of no component stands for itself."""
    first = reads.where(F.size("genes") > 0).withColumn("gene", F.col("genes")[0])
    return first.join(parts, "gene", "left").withColumn("component", F.coalesce("component", "gene")).drop("gene")


def torn_reads(reads: DataFrame, parts: DataFrame) -> DataFrame:
    """Reads whose genes lie in several components; there are none if the components come from these reads."""
    genes = reads.select("sample", "read_id", F.explode("genes").alias("gene")).join(parts, "gene", "left")
    return genes.groupBy("sample", "read_id").agg(F.size(F.collect_set(F.coalesce("component", "gene"))).cast("long").alias("n")).where("n > 1")


def normalized_counts(groups: DataFrame, dedup: bool = True) -> DataFrame:
    """Distinct molecule tags, or reads, per sample and component of genes that occur together; primers are no genes.

    ``groups``: sample, read_id, gene (genes and the primer pair, comma-joined), final_umi. A null tag counts as one tag.
    """
    every = _names(F.col("gene"))
    named = groups.select("sample", "read_id", F.slice(every, 1, F.greatest(F.size(every) - 1, F.lit(0))).alias("genes"), F.coalesce("final_umi", F.lit("")).alias("umi"))
    rows = _by_read(named.where(F.size("genes") > 0))
    reads = rows.groupBy("sample", "read_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("genes")))).alias("genes"), F.min("umi").alias("umi"))
    kinds = materialize(reads.groupBy("sample", "genes", "umi").agg(F.count("*").alias("reads")))  # reads are gone through once
    whole = read_components(kinds, gene_components(cooccurrence(kinds.select("genes").distinct())))
    number = F.count_distinct("umi") if dedup else F.sum("reads")
    return whole.groupBy("sample", "component").agg(number.alias("n"))


def rarefaction_plan(counts: DataFrame, metadata: DataFrame, repeats: int, depth: int | None = None, key: str | None = None) -> DataFrame:
    """Metadata of each rarefied sample: ``original_sample``, ``sample`` (``<s>_rarefied_<j>``), its total and ``target``.

    The target is the depth of the sample that ``key`` names, the number that it holds, or else ``depth`` (default: one below the
    least total). A name that is no sample raises. A sample of no more than its target comes once.
    """
    totals = counts.groupBy("sample").agg(F.sum("n").alias("total"))
    if depth is None:
        depth = (totals.agg(F.min("total")).first()[0] or 0) - 1
    wanted = F.col(key).cast("string") if key else F.lit(None).cast("string")
    rows = metadata.withColumn("__key", wanted).join(totals, "sample").join(totals.select(F.col("sample").alias("__key"), F.col("total").alias("__named")), "__key", "left")
    number = F.when(F.col("__key").rlike("^[0-9]+$"), F.col("__key").cast("long"))
    known = F.coalesce("__named", number, F.raise_error(F.concat(F.lit("no such sample: "), F.col("__key"))).cast("long"))
    rows = rows.withColumn("target", F.when(F.col("__key").isNull(), F.lit(depth).cast("long")).otherwise(known))
    draws = F.when(F.col("total") > F.col("target"), F.sequence(F.lit(0), F.lit(repeats - 1))).otherwise(F.array(F.lit(0)))
    named = rows.withColumn("__draw", F.explode(draws)).withColumn("original_sample", F.col("sample"))
    return named.withColumn("sample", F.concat_ws("_rarefied_", "sample", "__draw")).drop("__key", "__named", "__draw")


def rarefy(counts: DataFrame, depth: int, seed: int = 42, block: int = 4096) -> DataFrame:
    """Draw ``depth`` molecules of each deeper sample without replacement; others stay as they are.

    Molecules are ordered by a hash. Buckets of hash values hold about ``block`` molecules each,
    whatever the sample's depth; buckets are taken whole until the one that holds the last drawn
    molecule, and only there molecules are ranked. So a sample has one limit, which meets its cells; molecules are joined with nothing.
    A cell's copies are made in pieces of a bounded size, dealt to all cores.
    """
    counts = materialize(counts.select("sample", "feature", "n"))
    totals = counts.groupBy("sample").agg(F.sum("n").alias("total"))
    rows = counts.where("n > 0").join(totals, "sample")
    deep = rows.where(F.col("total") > depth)
    sizes = _molecules(deep, seed, block).groupBy("sample", "bucket").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("sample").orderBy("bucket")) - F.col("size")
    limits = sizes.withColumn("need", depth - before).where("need > 0").groupBy("sample").agg(F.max("bucket").alias("last"), F.min("need").alias("need"))
    # limits are written first: a plan that sees them and cells by their sizes never sends what the cells are exploded to
    taken = _molecules(deep.join(materialize(limits), "sample"), seed, block).where("bucket <= last")
    order = Window.partitionBy("sample", "bucket").orderBy("key", "feature", "copy")
    drawn = taken.withColumn("rn", F.row_number().over(order)).where("bucket < last or rn <= need").groupBy("sample", "feature").agg(F.count("*").alias("n"))
    return drawn.unionByName(rows.where(F.col("total") <= depth).select("sample", "feature", "n"))


def _molecules(cells: DataFrame, seed: int, block: int) -> DataFrame:
    """A row per molecule of ``cells`` (sample, feature, n, total): adds copy, key and bucket."""
    piece = 1 << 13
    pieces = spread(cells.withColumn("piece", F.explode(F.expr(f"sequence(0L, (n - 1) div {piece})"))), "sample", "feature", "piece")
    every = pieces.withColumn("copy", F.explode(F.expr(f"sequence(piece * {piece} + 1, least(n, (piece + 1) * {piece}))")))
    key = F.md5(F.concat_ws(":", "sample", "feature", "copy", F.lit(seed)))
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / (1 << 32)
    return every.withColumn("key", key).withColumn("bucket", F.floor(part * F.ceil(F.col("total") / block)))


def rarefy_repeats(counts: DataFrame, repeats: int, depth: int | None = None, seed: int = 42) -> DataFrame:
    """``repeats`` independent draws of each deeper sample, named ``<sample>_rarefied_<i>``; others come once, whole.

    Without a depth it is one below the least total of a sample.
    """
    totals = counts.groupBy("sample").agg(F.sum("n").alias("__total"))
    if depth is None:
        least = totals.agg(F.min("__total")).first()[0]
        depth = (least or 0) - 1
    draws = F.when(F.col("__total") > depth, F.sequence(F.lit(0), F.lit(repeats - 1))).otherwise(F.array(F.lit(0)))
    named = counts.join(totals.withColumn("__draw", F.explode(draws)), "sample").select(F.concat_ws("_rarefied_", "sample", "__draw").alias("sample"), "feature", "n")
    return rarefy(named, depth, seed)
