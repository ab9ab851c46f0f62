"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, Hamming check.

Defined results for odd input: a null or empty text has fingerprint zero, which links
like any other; a text with fewer words than a shingle is one shingle; a text of any length counts whole; a bit that
is set in just half of the shingles is 0; rows with the
same id keep their rows; a null id stays a row and never names a component that has
another id; an empty table gives an empty result. ``near_duplicates`` ignores other columns, and an id column named like an
output column comes out as name + ``_input``; ``keep_one`` returns the columns of ``docs`` as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyseq.llm.keep import keep_decided, text_key
from tallyseq.llm.names import clear_of
from tallyseq.operators.graph import connected_components
from tallyseq.operators.skew import join_hot
from tallyseq.session import materialize

BITS = 64
#: A block key with up to this many fingerprints is joined pair by pair; a larger one goes through tiles.
PAIRWISE = 64
#: Fingerprints on each side of a tile.
TILE = 1024


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of a whole text as an unsigned 64-bit number."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only \x20 and \x09-\x0D split
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(p, seed) for p in parts[at : at + 65536]], dtype=np.uint64) for at in range(0, len(parts), 65536))


def majority(hashes: Iterable[np.ndarray]) -> int:
    """The bits that are set in over half of the hashes, which come in parts; 0 for none."""
    votes, total = np.zeros(BITS, np.int64), 0
    for some in hashes:
        votes += np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(some)
    return int.from_bytes(np.packbits(votes * 2 > total, bitorder="little").tobytes(), "little")


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """The fingerprint as a signed long that has the same bits."""

    @F.pandas_udf(T.LongType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([simhash(t, shingle, seed) for t in texts], dtype=np.uint64).view(np.int64))

    return run(text)


def block_masks(distance: int, blocks: int) -> list[int]:
    """Bit masks of every choice of ``blocks - distance`` blocks: a pair within ``distance`` agrees on at least one."""
    if not 0 <= distance < blocks <= BITS:
        raise ValueError("0 <= distance < blocks <= 64 is needed")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(some) for some in combinations(masks, blocks - distance)]


def blocks_for(fingerprints: int, distance: int, spare: int = 3) -> int:
    """The least number of blocks whose keys have ``spare`` bits more than it takes to number the fingerprints.

    Unlike fingerprints then share few keys, at every size; each further block makes more keys of more bits.
    """
    wanted = max(1, fingerprints).bit_length() + spare
    for blocks in range(distance + 1, 2 * distance + 6):
        if min(m.bit_count() for m in block_masks(distance, blocks)) >= wanted:
            return blocks
    return 2 * distance + 5


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _tile_forest(distance: int):
    """Edges that span each connected part of a tile; the tile has at most 2 * TILE fingerprints."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(tile["fp"].to_numpy(np.int64)).view(np.uint64)
        near = np.empty((len(fps), len(fps)), bool)
        for at in range(0, len(fps), 256):
            near[at : at + 256] = np.bitwise_count(fps[at : at + 256, None] ^ fps[None, :]) <= distance
        label = np.arange(len(fps))
        while True:
            low = np.array([label[row].min() for row in near], dtype=np.int64) if len(fps) else label
            low = low[low]
            if (low == label).all():
                break
            label = low
        own = np.arange(len(fps))
        moved = label != own
        fps = fps.view(np.int64)
        return pd.DataFrame({"src": fps[own[moved]], "dst": fps[label[moved]]})

    return run


def hamming_links(fps: DataFrame, distance: int = 3, blocks: int = 5, pairwise: int = PAIRWISE, tile: int = TILE) -> DataFrame:
    """Links between distinct fingerprints that join the same fingerprints as all pairs within ``distance`` do.

    ``fps`` has one column ``fp`` of distinct longs. Small blocks are joined on their
    key and verified in the join. A block with more than ``pairwise`` members is cut
    into chunks of about ``tile`` and each pair of chunks is compared in a task of its
    own, which emits a spanning forest: all links count, none is emitted per pair.
    """
    masks = block_masks(distance, blocks)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part")) for i, m in enumerate(masks)]))
    keyed = fps.select("fp", keys.alias("k")).select("fp", "k.block", "k.part")
    heavy = materialize(keyed.groupBy("block", "part").agg(F.count("*").alias("members")).where(F.col("members") > pairwise))
    light = keyed.join(heavy, ["block", "part"], "left_anti")
    pairs = (
        light.alias("a")
        .join(light.alias("b").hint("merge"), ["block", "part"])  # a plan guesses exploded keys as small as the fingerprints and would send them through the driver
        .where("a.fp < b.fp")
        .where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance)
        .select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))
    )
    chunked = (
        keyed.join(heavy, ["block", "part"])
        .withColumn("chunks", F.ceil(F.col("members") / tile))
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), "chunks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("block", "part", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "fp")
    )
    forest = chunked.groupBy("block", "part", "lo", "hi").applyInPandas(_tile_forest(distance), "src long, dst long")
    return pairs.union(forest)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    seed: int = 42,
    distance: int = 3,
    blocks: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (signed long), ``component_id``, ``keeper``, ``text_key``.

    ``component_id`` is the smallest id that links reach. ``keeper`` marks the rows
    of a component that have its smallest id (and, where rows repeat that id with
    other texts, the smallest ``text_key``). Equal fingerprints collapse before any
    join, so a group of copies of any size costs one row; texts pass through no shuffle.
    """
    marked = materialize(docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"), fingerprint(F.col(text_col), shingle, seed).alias("fingerprint")))
    low = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("low")
    classes = materialize(marked.groupBy(F.col("fingerprint").alias("fp")).agg(low, F.count("*").alias("members")))
    total = marked.count()
    blocks = blocks or blocks_for(classes.count(), distance)
    parts = connected_components(hamming_links(classes.select("fp"), distance, blocks)).withColumnRenamed("node", "fp")
    grouped = classes.join(parts, "fp", "left").select("fp", "low", "members", F.coalesce("component", "fp").alias("part"))
    lows = grouped.groupBy("part").agg(F.min("low").alias("first"), F.count("*").alias("parts"))
    of_fp = join_hot(grouped, lows, "part", total, "parts").select(F.col("fp").alias("fingerprint"), "members", "first")
    keeper = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key"))
    found = join_hot(marked, of_fp, "fingerprint", total)
    own = clear_of(docs.select(id_col), "fingerprint", "component_id", "keeper", "text_key").columns[0]
    return found.select(F.col("id").alias(own), "fingerprint", F.col("first.id").alias("component_id"), keeper.alias("keeper"), "text_key")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each near-duplicate group, with all columns of ``docs``: the keeper; of equal rows that are, one."""
    found = near_duplicates(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__id", "__text", **how)
    found = materialize(found.select("__id", F.col("text_key").alias("__key"), F.col("keeper").alias("__keeper")))
    return keep_decided(docs, found, id_col, text_col)
