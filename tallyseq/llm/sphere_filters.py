"""Embedding near-duplicates: spherical-cap filters of structured random product codes.

A filter is a direction made of one random unit vector per block of coordinates, behind a random
rotation. Each vector is list-decoded to the directions whose inner product with it exceeds its cap
height, which lets ``least_filters`` directions of each of ``codes`` independent codes through: how a
vector's length is spread over the blocks then does not decide whether its neighbours are found. The best
sums of two blocks are made of the best of either, so the exponentially many directions are never
enumerated and whole batches are decoded at once. The number of words in a code follows from the number of vectors,
so that unlike vectors share few filters at every size.

Vectors meet in the filters that they share and are then verified in double precision. Filters of few members
give pairs, which are made distinct before any vector is shipped. Larger ones are cut into tiles of bounded size,
which tell counts and a spanning forest; a pair that shares several of those counts in the first one only.

Defined results for odd input: null, zero, empty or non-finite vectors and vectors with null components link
with nothing; vectors of different lengths do not link, each length is compared among its own; equal vectors link
with one another; rows with equal ids count as vectors of their own; a null id stays a row and names a component
only if none has an id; other columns are ignored; an empty table gives an empty result. An id column that is
named like an output column comes out as name + ``_input``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyseq.llm.names import clear_of
from tallyseq.operators.graph import connected_components
from tallyseq.operators.skew import join_hot
from tallyseq.session import materialize

#: Vectors on each side of a tile.
TILE = 512
#: Members up to which a filter gives pairs.
PAIRWISE = 8
BLOCKS = 4
#: Directions of a code for each filter that all vectors take of it together.
SPREAD = 20
FEWEST_WORDS, MOST_WORDS = 24, 1600
#: A direction's number within a code stays below 2 ** this.
NUMBER_BITS = 43


def words_for(vectors: int, least_filters: int) -> int:
    """Words per block: unlike vectors then meet in one filter out of ``SPREAD``."""
    wanted = (SPREAD * least_filters * max(1, vectors)) ** (1 / BLOCKS)
    return min(MOST_WORDS, max(FEWEST_WORDS, math.ceil(wanted)))


def codes_for(words: int, codes: int) -> int:
    """Codes that keep recall where they have many words: a code of more words tells less of a pair, so 2 come with each doubling above 300."""
    return codes + max(0, math.ceil(2.1 * math.log2(words / 300)))


class ProductCode:
    """``words ** 4`` directions in ``dim`` dimensions; fewer dimensions than blocks need are filled up with zeros."""

    def __init__(self, dim: int, words: int, least_filters: int, seed: int):
        draw = np.random.default_rng(seed)
        self.dim = max(dim, 2 * BLOCKS)
        self.words, self.least = words, least_filters
        self.rotation = np.linalg.qr(draw.standard_normal((self.dim, self.dim)))[0]
        cuts = [self.dim * i // BLOCKS for i in range(BLOCKS + 1)]
        self.spans = [*zip(cuts, cuts[1:], strict=False)]
        self.books = []
        for lo, hi in self.spans:
            book = draw.standard_normal((words, hi - lo))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True) / math.sqrt(BLOCKS))

    def _best(self, sums: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest ``least`` sums of each row, descending, with their numbers."""
        k = min(self.least, sums.shape[1])
        at = np.argpartition(-sums, k - 1, axis=1)[:, :k]
        some = np.take_along_axis(sums, at, 1)
        order = np.argsort(-some, axis=1, kind="stable")
        return np.take_along_axis(some, order, 1), np.take_along_axis(np.take_along_axis(numbers, at, 1), order, 1)

    def _joined(self, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], radix: int) -> tuple[np.ndarray, np.ndarray]:
        """The best sums of two parts: the (i, j)-th of their sorted lists has (i + 1) * (j + 1) - 1 others above it."""
        pairs = [(i, j) for i in range(left[0].shape[1]) for j in range(right[0].shape[1]) if (i + 1) * (j + 1) <= self.least]
        i, j = np.array(pairs).T
        return self._best(left[0][:, i] + right[0][:, j], left[1][:, i] * radix + right[1][:, j])

    def decode(self, unit: np.ndarray) -> np.ndarray:
        """For each row of unit vectors the numbers of the directions above its cap height."""
        turned = unit @ self.rotation[:, : unit.shape[1]].T
        parts = []
        for book, (lo, hi) in zip(self.books, self.spans, strict=True):
            sums = turned[:, lo:hi] @ book.T
            parts.append(self._best(sums, np.broadcast_to(np.arange(self.words, dtype=np.int64), sums.shape)))
        left, right = (self._joined(parts[k], parts[k + 1], self.words) for k in (0, 2))
        return self._joined(left, right, self.words**2)[1]


@lru_cache(maxsize=64)
def code_of(dim: int, words: int, least_filters: int, seed: int) -> ProductCode:
    return ProductCode(dim, words, least_filters, seed)


def units(vectors: list) -> np.ndarray:
    """Rows of unit length; scaled by the largest component first, so that no square overflows or vanishes."""
    x = np.stack(vectors).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def filters_of(vectors: list, words: int, least_filters: int, codes: int, seed: int) -> np.ndarray:
    """Filter numbers of vectors of one length, told apart by length and code."""
    x = units(vectors)
    dim = x.shape[1]
    found = [code_of(dim, words, least_filters, seed + c).decode(x) + ((dim * codes + c) << NUMBER_BITS) for c in range(codes)]
    return np.concatenate(found, axis=1)


def _decode_rows(words: int, least_filters: int, codes: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = np.empty(len(rows), object)
            lengths = rows["v"].map(len).to_numpy()
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                for some in np.array_split(at, -(-len(at) // 2048)):
                    for i, f in zip(some, filters_of([rows["v"].iloc[k] for k in some], words, least_filters, codes, seed), strict=True):
                        found[i] = f
            yield rows.assign(filters=found)

    return run


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of ``a`` with those of ``b``, in double precision."""
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def _scaled(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_list()).astype(np.float64)
    return x / np.abs(x).max(axis=1, keepdims=True)


def _verify_pairs(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            near = np.zeros(len(rows), bool)
            lengths = rows["va"].map(len).to_numpy()
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                near[at] = cosines(_scaled(rows["va"].iloc[at]), _scaled(rows["vb"].iloc[at])) >= threshold
            got = rows[near]
            yield pd.DataFrame({"rep": got["a"], "other": got["b"], "links": got["copies_b"]})
            yield pd.DataFrame({"rep": got["b"], "other": got["a"], "links": got["copies_a"]})

    return run


def _verify_tiles(threshold: float):
    """Compare what shares a tile: count each linked pair in its first common large filter only, and span the linked parts."""

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        own, lo, hi = int(rows["f"].iloc[0]), rows["lo"].iloc[0], rows["hi"].iloc[0]
        rep, copies, chunk = rows["rep"].to_numpy(), rows["copies"].to_numpy(np.int64), rows["chunk"].to_numpy()
        x = _scaled(rows["v"])
        near = (x @ x.T) / np.sqrt((x * x).sum(axis=1)[:, None] * (x * x).sum(axis=1)[None, :]) >= threshold
        np.fill_diagonal(near, False)
        if lo != hi:  # pairs inside a chunk are the business of that chunk's own tile
            near &= chunk[:, None] != chunk[None, :]
        if not near.any():
            return pd.DataFrame({"rep": rep[:0], "other": rep[:0], "links": copies[:0]})
        earlier = [f[f < own] for f in rows["large"]]
        names, at = np.unique(np.concatenate(earlier), return_inverse=True)
        has = np.zeros((len(rep), max(1, len(names))), np.float32)
        has[np.repeat(np.arange(len(rep)), [len(e) for e in earlier]), at] = 1
        first = near & ~(has @ has.T > 0)
        label = np.arange(len(rep))
        while True:
            low = np.minimum(np.where(near, label[None, :], len(rep)).min(axis=1), label)
            low = low[low]
            if (low == label).all():
                break
            label = low
        links = first @ copies
        told = (links > 0) | (label != np.arange(len(rep)))
        return pd.DataFrame({"rep": rep[told], "other": rep[label[told]], "links": links[told]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for rows in batches:
            rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
            key = rows[["f", "lo", "hi"]]
            ends = (key != key.shift(-1)).any(axis=1).to_numpy()
            if not len(ends):
                continue
            ends[-1] = False  # the last tile may go on in the next batch
            cuts = [0, *(np.nonzero(ends)[0] + 1)]
            out = [group(rows.iloc[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            rest = rows.iloc[cuts[-1] :]
            if out := [x for x in out if len(x)]:
                yield pd.concat(out)
        if rest is not None and len(rest):
            yield group(rest)

    return run


LINK = "rep long, other long, links long"


def shared_links(decoded: DataFrame, threshold: float, tile: int = TILE, pairwise: int = PAIRWISE) -> DataFrame:
    """``(rep, other, links)``: links per class with a forest of edges, of classes (rep, copies, v, filters) that share a filter.

    The links of a class add up to the number of vectors of other classes that it is linked to.
    """
    entries = decoded.select("rep", F.explode("filters").alias("f"))
    shared = materialize(entries.groupBy("f").agg(F.count("*").alias("members")).where("members > 1"))
    total = shared.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    met = materialize(join_hot(entries, shared, "f", max(total, decoded.count())))
    large = met.where(F.col("members") > pairwise)
    lists = large.groupBy("rep").agg(F.sort_array(F.collect_list("f")).alias("large"))
    narrow = decoded.select("rep", "copies", "v")
    held = F.transform(F.col("some"), lambda x, i: F.transform(F.slice(F.col("some"), i + 2, pairwise), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    pairs = met.where(F.col("members") <= pairwise).groupBy("f").agg(F.sort_array(F.collect_list("rep")).alias("some")).select(F.explode(F.flatten(held)).alias("p")).select("p.a", "p.b").distinct()
    # pairs that share a large filter count there
    one, two = (lists.select(F.col("rep").alias(x), F.col("large").alias(f"large_{x}")) for x in ("a", "b"))
    pairs = pairs.join(one, "a", "left").join(two, "b", "left").where(~F.coalesce(F.arrays_overlap("large_a", "large_b"), F.lit(False))).select("a", "b")
    va, vb = (narrow.select(F.col("rep").alias(x), F.col("copies").alias(f"copies_{x}"), F.col("v").alias(f"v{x}")) for x in ("a", "b"))
    by_pairs = pairs.join(va, "a").join(vb, "b").mapInPandas(_verify_pairs(threshold), LINK)
    tiles = (
        large.withColumn("chunks", F.ceil(F.col("members") / tile))
        .withColumn("chunk", F.pmod(F.xxhash64(F.lit(2), "rep"), "chunks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("rep", "f", "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))
    )
    by_tiles = tiles.join(narrow.join(lists, "rep"), "rep").repartition("f", "lo", "hi").sortWithinPartitions("f", "lo", "hi").mapInPandas(_verify_tiles(threshold), LINK)
    return materialize(by_pairs.union(by_tiles))


def embedding_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    codes: int = 6,
    least_filters: int = 6,
    seed: int = 7,
    tile: int = TILE,
    pairwise: int = PAIRWISE,
) -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links``, ``component_id`` and ``kept``.

    Equal vectors collapse first, by two independent hashes of their components. More ``codes`` or
    ``least_filters`` find more of the pairs just at the threshold, for as many more rows shuffled.
    """
    v = F.col(vector_col)
    usable = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(usable, v).alias("v"))
    rows = rows.withColumns({"h1": F.xxhash64(F.lit(1), "v"), "h2": F.xxhash64(F.lit(2), "v")})
    words = words_for(vectors.count(), least_filters)
    codes = codes_for(words, codes)
    classes = rows.where("v is not null").groupBy("h1", "h2").agg(F.min("id").alias("low"), F.count("*").alias("copies"), F.any_value("v").alias("v"))
    classes = classes.withColumn("rep", F.monotonically_increasing_id())
    kind = {f.name: f.dataType.simpleString() for f in classes.schema}
    schema = ", ".join(f"{c} {k}" for c, k in kind.items()) + ", filters array<bigint>"
    decoded = materialize(classes.mapInPandas(_decode_rows(words, least_filters, codes, seed), schema))
    told = shared_links(decoded.select("rep", "copies", "v", "filters"), threshold, tile, pairwise)
    parts = connected_components(told.select("rep", "other"))
    links = told.groupBy("rep").agg(F.sum("links").alias("links"))
    grouped = decoded.select("rep", "h1", "h2", "low", "copies").join(links, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    grouped = materialize(grouped.select("h1", "h2", "low", F.col("copies").alias("members"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("part")))
    lows = grouped.groupBy("part").agg(F.min("low").alias("component_id"), F.count("*").alias("parts"))
    total = vectors.count()
    of_class = join_hot(grouped, lows, "part", total, "parts").select("h1", "h2", "members", "n_links", "component_id")
    usable_rows = join_hot(rows.where("v is not null").select("id", "h1", "h2"), of_class, ["h1", "h2"], total)
    none = rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    found = usable_rows.select("id", "n_links", "component_id").unionByName(none)
    component = F.coalesce("component_id", "id")
    out = found.select("id", F.col("n_links").cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
    own = clear_of(vectors.select(id_col), "n_links", "component_id", "kept").columns[0]
    return out.withColumnRenamed("id", own)
