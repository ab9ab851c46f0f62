"""Near copies by shared word shingles: SimHash blocks and min-hash bands find candidates, exact Jaccard decides.

A text is its set of lower-case shingles of five words, each a 64-bit hash. Two texts are
linked if ``|A & B| / |A | B|`` is at least 0.8, counted on the sets themselves. First candidates are
those whose SimHash fingerprints over the set differ in at most ``DISTANCE`` bits, by the pigeonhole blocks of ``simhash``. Those bits
meet only part of the pairs that are similar, so more candidates
agree on all rows of one of the bands; a pair at exactly 0.8 meets in none with probability
``(1 - 0.8 ** ROWS) ** BANDS`` (7 in a million), more similar ones with less.

Rows of a band are so many that unlike texts of one common passage rarely meet. Members of a bucket that seeded members have not
joined yet meet by its groups: few members outside its largest group are paired with the others, at most ``PAIRWISE`` pairs for each
member; more of them are compared in tiles of at most ``2 * TILE`` members, which hold the sets themselves and tell edges that span what is
similar, so a tile never tells more edges than it has members.

Defined results for odd input: null and empty texts have the empty set and are copies of one
another; a text with fewer words than a shingle is one shingle; rows with the same id keep
their rows; a null id names a group only if none has an id; a text of any length counts whole; an empty table gives an
empty result. ``copy_groups`` ignores other columns, and an id column named like an output column comes out as name + ``_input``;
``keep_one`` returns the columns of ``docs`` as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyseq.llm import simhash
from tallyseq.llm.keep import keep_decided, text_key
from tallyseq.llm.names import clear_of
from tallyseq.operators.graph import connected_components
from tallyseq.operators.skew import join_hot
from tallyseq.session import materialize

BANDS = 65
ROWS = 8
SHINGLE = 5
#: Bits in which fingerprints of candidates differ at most.
DISTANCE = 3
#: At least this share, as a fraction of whole numbers: no rounding at the edge.
SIMILAR = (4, 5)
#: Members outside a bucket's largest group up to which they are paired with all others.
PAIRWISE = 16
#: Members of a chunk of a bucket; two chunks meet in a tile.
TILE = 128
_DRAW = np.random.default_rng(64)
_TIMES = _DRAW.integers(0, 2**64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)
_PLUS = _DRAW.integers(0, 2**64, (BANDS * ROWS, 1), dtype=np.uint64)
_WORD_TIMES = _DRAW.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only \x20 and \x09-\x0D split
    if not words:
        return np.empty(0, np.uint64)
    known = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    each = np.array([known[w] for w in words], dtype=np.uint64)
    long = min(size, len(each))
    total = np.full(len(each) - long + 1, long, np.uint64)
    for i in range(long):
        total = total + each[i : len(each) - long + 1 + i] * _WORD_TIMES[i]
    return np.unique(_mixed(total))


def band_keys(some: np.ndarray) -> np.ndarray:
    """One key a band."""
    low = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(some), 512):
        np.minimum(low, (some[None, at : at + 512] * _TIMES + _PLUS).min(axis=1), out=low)
    rows = low.astype("<u8").reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), band) for band, r in enumerate(rows)], dtype=np.uint64).view(np.int64)


def _shape(text: Column) -> Column:
    """A key of the whole set, its size, its fingerprint, and its bands."""

    @F.pandas_udf("set_key long, n long, fp long, bands array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingles(t) for t in texts]
            keys = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64)
            fps = np.array([simhash.majority([s]) for s in sets], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"set_key": keys, "n": [len(s) for s in sets], "fp": fps, "bands": [band_keys(s) for s in sets]})

    return run(text)


def _set_of(text: Column) -> Column:
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingles(t).view(np.int64) for t in texts])

    return run(text)


def _similar(shared: Column, sizes: Column) -> Column:
    up, down = SIMILAR
    return shared * (up + down) >= sizes * up


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (src, dst) whose sets are similar."""
    a = sets.select(F.col("node").alias("src"), F.col("some").alias("some_a"))
    b = sets.select(F.col("node").alias("dst"), F.col("some").alias("some_b"))
    shared = F.size(F.array_intersect("some_a", "some_b"))
    return pairs.join(a, "src").join(b, "dst").where(_similar(shared, F.size("some_a") + F.size("some_b"))).select("src", "dst")


def _could(a: Column, b: Column) -> Column:
    """Sizes with which sets can be similar: all of the smaller one is shared."""
    return _similar(F.least(a, b), a + b)


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``text_key``, ``component_id`` (smallest id that links reach), ``keeper``.

    Equal sets collapse first. Sets of near fingerprints meet, and in each bucket one seeded member meets the others. Then members of a bucket that are
    still in different groups meet. Pairs in one group need no comparison, so a large group is not squared.
    """
    marked = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"), _shape(F.col(text_col)).alias("s"))
    marked = materialize(marked.select("id", "text_key", "s.*"))
    low = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("low")
    classes = materialize(marked.groupBy(F.col("set_key").alias("node"), "n").agg(low, F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands"), F.count("*").alias("members")))
    total = marked.count()
    spots = classes.select("node", "n", F.explode("bands").alias("bucket"))
    members = _led(spots)
    near = _near_fingerprints(classes.select("node", "fp"))
    candidates = members.select("node").union(near.select("src")).union(near.select("dst")).distinct().join(classes.select("node", "low"), "node")
    candidates = candidates.select("node", F.col("low.id").alias("__id"), F.col("low.text_key").alias("__key"))
    rows = docs.select(F.col(id_col).alias("__of"), text_key(F.col(text_col)).alias("__text_key"), F.col(text_col).alias("__text"))
    texts = rows.join(candidates, (F.col("__text_key") == F.col("__key")) & F.col("__of").eqNullSafe(F.col("__id")))
    sets = materialize(texts.select("node", _set_of(F.col("__text")).alias("some")).dropDuplicates(["node"]))
    links, parts = _stars(members, sets, near)
    parts = _rest(members, sets, links, parts)
    of = classes.select("node", "low", "members").join(parts, "node", "left").select("node", "low", "members", F.coalesce("component", "node").alias("part"))
    lows = of.groupBy("part").agg(F.min("low").alias("first"), F.count("*").alias("parts"))
    firsts = join_hot(of, lows, "part", total, "parts").select(F.col("node").alias("set_key"), "members", "first")
    keeper = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key"))
    found = join_hot(marked.select("id", "text_key", "set_key"), firsts, "set_key", total)
    own = clear_of(docs.select(id_col), "text_key", "component_id", "keeper").columns[0]
    return found.select(F.col("id").alias(own), "text_key", F.col("first.id").alias("component_id"), keeper.alias("keeper"))


def _led(spots: DataFrame) -> DataFrame:
    """Members (node, n, bucket) of buckets that have others, with a seeded member of the bucket as ``lead``."""
    seeded = F.struct(F.xxhash64("node", "bucket").alias("place"), F.col("node").alias("node"), F.col("n").alias("n"))
    met = spots.groupBy("bucket").agg(F.min(seeded).alias("lead"), F.count("*").alias("members")).where("members > 1")
    held = met.select("bucket", "members", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n"))
    return materialize(join_hot(spots, held, "bucket", spots.count()))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")]


def _near_fingerprints(classes: DataFrame) -> DataFrame:
    """Pairs (src, dst) of classes (node, fp) by SimHash: those of one fingerprint with the first of them, and the first ones of linked fingerprints."""
    leads = materialize(classes.groupBy("fp").agg(F.min("node").alias("lead"), F.count("*").alias("members")))
    links = simhash.hamming_links(leads.select("fp"), DISTANCE, simhash.blocks_for(leads.count(), DISTANCE))
    one, other = (leads.select(F.col("fp").alias(end), F.col("lead").alias(f"{end}_lead")) for end in ("src", "dst"))
    across = links.distinct().join(one, "src").join(other, "dst").select(*_pair("src_lead", "dst_lead"))
    within = join_hot(classes, leads.where("members > 1"), "fp", classes.count()).where("node <> lead").select(*_pair("node", "lead"))
    return materialize(across.union(within).distinct())


def _stars(members: DataFrame, sets: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sets of near fingerprints meet, and each bucket's lead meets the other members: the links, and the groups that they make."""
    rows = members.where("node <> lead").where(_could(F.col("n"), F.col("lead_n")))
    links = materialize(_linked(near.union(rows.select(*_pair("node", "lead"))).distinct(), sets))
    return links, connected_components(links)


def _tile_edges(tile: pd.DataFrame) -> pd.DataFrame:
    """Edges between similar sets of different groups, as few as join the same groups."""
    tile = tile.drop_duplicates("node")
    nodes, sets = tile["node"].to_numpy(np.int64), [np.asarray(x, np.int64) for x in tile["some"]]
    sizes = np.array([len(x) for x in sets])
    label = np.unique(tile["part"].to_numpy(np.int64), return_inverse=True)[1]
    held, shingle = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    order = np.argsort(shingle, kind="stable")
    held, (_, first, count) = held[order], np.unique(shingle[order], return_index=True, return_counts=True)
    place = np.empty(len(order), np.int64)
    place[order] = np.repeat(np.arange(len(first)), count)  # which distinct shingle each place of the sets has
    up, down = SIMILAR
    src, dst = [], []
    for i, at in enumerate(np.cumsum(sizes) - sizes):
        own = place[at : at + sizes[i]]
        starts, lengths = first[own], count[own]
        hits = np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        shared = np.bincount(held[hits], minlength=len(sets))
        for j in np.flatnonzero((shared * (up + down) >= (sizes + sizes[i]) * up) & (label != label[i])):
            if label[j] != label[i]:
                src.append(max(nodes[i], nodes[j]))
                dst.append(min(nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return pd.DataFrame({"src": np.array(src, np.int64), "dst": np.array(dst, np.int64)})


def _rest(members: DataFrame, sets: DataFrame, links: DataFrame, parts: DataFrame) -> DataFrame:
    """The groups after members of a bucket that are in different groups have met too."""
    rows = members.join(parts, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("part"))
    shares = rows.groupBy("bucket", "part").agg(F.count("*").alias("own"))
    mixed = shares.groupBy("bucket").agg(F.sum("own").alias("members"), F.max("own").alias("most"), F.max_by("part", F.struct("own", "part")).alias("main"))
    mixed = mixed.where("members > most").withColumn("others", F.col("members") - F.col("most"))
    open_ = materialize(join_hot(rows, mixed, "bucket", members.count()))
    light = open_.where(F.col("others") <= PAIRWISE)
    few = light.where("part <> main").select("bucket", F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("part").alias("other_part"))
    # two members outside the largest group meet once
    pairs = light.join(few, "bucket").where("part <> other_part and (part = main or node < other)").where(_could(F.col("n"), F.col("other_n")))
    found = _linked(pairs.select(*_pair("node", "other")).distinct(), sets)
    chunks = F.ceil(F.col("members") / TILE)
    heavy = open_.where(F.col("others") > PAIRWISE).withColumn("chunk", F.pmod(F.xxhash64("node", "bucket"), chunks)).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    placed = materialize(heavy.select("bucket", F.least("chunk", "with").alias("low"), F.greatest("chunk", "with").alias("high"), "node", "part"))  # so a plan knows its size
    tiles = placed.join(sets, "node")
    found = materialize(found.unionByName(tiles.groupBy("bucket", "low", "high").applyInPandas(_tile_edges, "src long, dst long")))
    return connected_components(links.unionByName(found)) if found.limit(1).count() else parts


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, with all columns of ``docs``: the keeper; of equal rows that are, one."""
    found = copy_groups(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__id", "__text")
    found = materialize(found.select("__id", F.col("text_key").alias("__key"), F.col("keeper").alias("__keeper")))
    return keep_decided(docs, found, id_col, text_col)
