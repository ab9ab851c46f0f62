"""A trie of conversations by shared first turns, built by distributed radix partitioning.

Turns become dictionary ids, conversations become sequences of ids, and equal sequences become one with a number of copies.
Most-significant-digit radix partitioning then parts the sequences by their first turn, the parts by the second, and so on:
each round reads one position, counts its buckets (which are the nodes of that depth) and goes on only in buckets that
still hold more than ``LOCAL_TURNS`` turns. Smaller buckets are finished where they are: tasks read them one after another, sort
each by multikey quicksort, and every set of equal keys that the recursion meets is a node. Sums over subtrees then
climb from the finished buckets to the nodes of the rounds, one level at a time.

Sizes: a bucket in a task has at most ``LOCAL_TURNS`` turns; one sequence that is longer and shares its bucket with no other is
told by windows instead, which need no memory of its length. Hot turns and hot buckets meet their row by a bounded
broadcast (``operators/skew.py``). Rounds are as many as the depth to which more than ``LOCAL_TURNS`` turns share a beginning;
copies don't count, as they are one sequence. Sequences are told equal by their length and two 64-bit digests over
(place, id), so that no conversation is gathered in a row. The digest of the conversations that end at a node is a SHA-256 over
their ids in order; it is made by streaming over sorted rows, but a hash of this kind cannot be split.

Defined results for odd input: null roles and texts are empty; a null turn comes first; turns that tie stand in the order of
their digests, and repeated rows count as turns of their own; rows without a conversation id belong to no conversation and
are left out; a conversation that loses all turns to its rebuilding ends at the root; an empty table gives an empty
result (no conversation, no root); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.operators.skew import join_hot
from tallyseq.session import materialize

#: Conversations whose ids agree up to the last digits share their beginning; how many turns follows from a digest.
FAMILY = 20
MOST_SHARED = 4
#: Turns of a bucket that one task sorts.
LOCAL_TURNS = 8192
WORD = r"[^\x20\x09-\x0D]+"
NO_DIGEST = hashlib.sha256(b"").hexdigest()


def coded_turns(turns: DataFrame) -> DataFrame:
    """Turns as (conv, pos from 1, id, words): equal (role, text) have equal ids; no text is shuffled."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), "turn", key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    rows = materialize(rows)
    known = rows.groupBy("key").agg(F.count("*").alias("members"))
    known = materialize(known.withColumn("id", F.monotonically_increasing_id()))
    coded = join_hot(rows, known, "key", rows.count())
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "key")
    return materialize(coded.select("conv", F.row_number().over(order).cast("long").alias("pos"), "id", "words"))


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(coded: DataFrame) -> DataFrame:
    """Each conversation with the first turns of its family's first in place of its own; place 0 is a turn of no words with id -1."""
    base = F.col("conv") - F.col("conv") % FAMILY
    sizes = materialize(coded.groupBy("conv").agg(F.count("*").alias("size"))).withColumns({"base": base, "shared": shared_turns(F.col("conv"))})
    first = sizes.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    plan = materialize(sizes.join(first, "base", "left").withColumn("taken", F.least("shared", F.coalesce("base_size", F.lit(0)))))
    heads = coded.where(F.col("pos") < MOST_SHARED).withColumnRenamed("conv", "base").join(plan.where("taken > 0").select("base", "conv", "taken"), "base").where("pos <= taken")
    tails = join_hot(coded, plan.select("conv", "shared", "taken", F.col("size").alias("members")), "conv", coded.count()).where("pos > shared")
    top = plan.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(-1).cast("long").alias("id"), F.lit(0).cast("long").alias("words"))
    return top.unionByName(heads.select("conv", "pos", "id", "words")).unionByName(tails.select("conv", (F.col("pos") - F.col("shared") + F.col("taken")).alias("pos"), "id", "words"))


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences (seq: its smallest conversation, copies, size) and the sequence of each conversation that has copies."""
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "pos", "id")).alias(f"mark{seed}") for seed in (1, 2)]
    marked = materialize(turns.groupBy("conv").agg((F.count("*") - 1).alias("size"), *marks))
    keys = ["size", "mark1", "mark2"]
    found = marked.groupBy(*keys).agg(F.min("conv").alias("seq"), F.count("*").alias("copies"))
    found = materialize(found)
    several = found.where("copies > 1").select(*keys, "seq", F.col("copies").alias("members"))
    return found.select("seq", "copies", "size"), join_hot(marked, several, keys, marked.count()).select("seq", "conv")


def end_digests(members: DataFrame) -> DataFrame:
    """SHA-256 of each sequence's conversations, ascending and joined by commas: sorted rows stream through the hash."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for seq, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if seq != now:
                    if state:
                        done.append((now, state.hexdigest()))
                    now, state = seq, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])], ["end_seq", "ends"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["end_seq", "ends"])

    return members.select("seq", "conv").repartition("seq").sortWithinPartitions("seq", "conv").mapInArrow(digest, "end_seq long, ends string")


#: What a finished bucket tells of each of its nodes.
NODE = "bucket long, top boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, end_seq long, end_copies long"


def multikey_nodes(members: list[tuple[list[int], list[int], int, int]], depth: int, parent: int | None) -> list[list]:
    """The nodes below and with the one that all ``members`` share.

    A member is (ids, words, seq, copies) with ids from the shared node on, so the node at ``ids[at]`` has depth ``depth + at``.
    Three-way partitioning around a pivot sorts the members by the id at a place; those equal to it are a node, and are
    sorted by the next place. A node is a list: parent's place in the result, then the fields from conv_id on.
    """
    nodes: list[list] = []
    todo = [(members, 0, -1)]
    while todo:
        rows, at, up = todo.pop()
        pivot = rows[len(rows) // 2][0][at]
        low, same, high = [], [], []
        for r in rows:
            x = r[0][at]
            (same if x == pivot else low if x < pivot else high).append(r)
        todo += [(part, at, up) for part in (low, high) if part]
        copies = sum(r[3] for r in same)
        end = next((r for r in same if len(r[0]) == at + 1), None)
        nodes.append([up, min(r[2] for r in same), depth + at, nodes[up][1] if up >= 0 else parent, copies, 0, 0, (copies - 1) * same[0][1][at], end and end[2], end and end[3]])
        if up >= 0:
            nodes[up][5] += 1
        if further := [r for r in same if len(r[0]) > at + 1]:
            todo.append((further, at + 1, len(nodes) - 1))
    for node in reversed(nodes):
        node[6] = node[6] or 1
        if node[0] >= 0:
            nodes[node[0]][6] += node[6]
            nodes[node[0]][7] += node[7]
    return nodes


def finished(rows: DataFrame) -> DataFrame:
    """All nodes of buckets that fit into a task. ``rows``: bucket, depth, up, seq, copies, pos, id, words."""

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int64()), ("top", pa.bool_())] + [(n.split()[0], pa.int64()) for n in NODE.split(", ")[2:]])
        now, head, members, done = None, (0, None), [], []

        def close() -> None:
            if members:
                done.extend((now, n[0] < 0, *n[1:]) for n in multikey_nodes(members, *head))

        for batch in batches:
            for bucket, depth, up, seq, copies, id_, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket != now:
                    close()
                    now, head, members = bucket, (depth, up), []
                if not members or members[-1][2] != seq:
                    members.append(([], [], seq, copies))
                members[-1][0].append(id_)
                members[-1][1].append(words)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema)
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema)

    own = rows.repartition("bucket").sortWithinPartitions("bucket", "seq", "pos")
    return own.select("bucket", "depth", "up", "seq", "copies", "id", "words").mapInArrow(finish, NODE)


def lone_nodes(rows: DataFrame) -> DataFrame:
    """The nodes of a bucket's only sequence: a chain, told by a window."""
    later = Window.partitionBy("seq").orderBy(F.col("pos").desc())
    end = F.col("pos") == F.col("size")
    return rows.select(
        "bucket",
        (F.col("pos") == F.col("depth")).alias("top"),
        F.col("seq").alias("conv_id"),
        F.col("pos").alias("depth"),
        F.when(F.col("pos") == F.col("depth"), F.col("up")).otherwise(F.col("seq")).alias("parent_conv_id"),
        F.col("copies").alias("n_convs"),
        (~end).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.sum((F.col("copies") - 1) * F.col("words")).over(later).alias("saved_tokens"),
        F.when(end, F.col("seq")).alias("end_seq"),
        F.when(end, F.col("copies")).alias("end_copies"),
    )


def _with_subtrees(wide: DataFrame, kids: DataFrame, depth: int) -> DataFrame:
    """Nodes of a round with the sums over their children."""
    sums = kids.groupBy(F.col("node").alias("bucket")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
    return wide.join(sums, "bucket").select(
        "bucket",
        F.lit(False).alias("top"),
        "conv_id",
        F.lit(depth).cast("long").alias("depth"),
        F.col("up").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        ((F.col("n_convs") - 1) * F.col("words") + F.col("saved")).alias("saved_tokens"),
        "end_seq",
        "end_copies",
    )


def trie(turns: DataFrame, known: DataFrame, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """The nodes of the distinct sequences ``known`` (seq, copies, size) whose turns are ``turns`` (seq, pos, id, words)."""
    turns = materialize(turns.join(known, "seq"))
    n_turns = turns.count()
    open_ = known.select("seq", F.lit(None).cast("long").alias("node"), F.lit(None).cast("long").alias("up"))
    depth, levels, small = 0, [], None
    while True:
        #: One digit: the sequences of each open node by the turn at this depth.
        digit = materialize(turns.where(F.col("pos") == depth).join(open_, "seq"))
        kids = digit.groupBy("node", "up", "id").agg(
            F.min("seq").alias("conv_id"), F.sum("copies").alias("n_convs"), F.count("*").alias("members"), F.sum(F.col("size") - depth + 1).alias("turns"), F.max("words").alias("words"),
            F.max(F.when(F.col("size") == depth, F.col("seq"))).alias("end_seq"), F.max(F.when(F.col("size") == depth, F.col("copies"))).alias("end_copies"),
        )
        kids = materialize(kids.withColumn("bucket", F.monotonically_increasing_id() * 2**12 + depth if depth < 2**12 else F.raise_error(F.lit("more than 4,096 rounds")).cast("long")))
        levels.append(kids)
        placed = materialize(join_hot(digit.select(F.coalesce("node", F.lit(-1)).alias("node"), "id", "seq", "size"), kids.select(F.coalesce("node", F.lit(-1)).alias("node"), "up", "id", "members", "bucket", "turns", "conv_id"), ["node", "id"], n_turns))
        done = placed.where((F.col("turns") <= local_turns) | (F.col("members") == 1)).select("seq", "bucket", F.lit(depth).cast("long").alias("depth"), "up", ((F.col("turns") > local_turns) & (F.col("members") == 1)).alias("lone"))
        small = done if small is None else small.unionByName(done)
        open_ = placed.where((F.col("turns") > local_turns) & (F.col("members") > 1) & (F.col("size") > depth)).select("seq", F.col("bucket").alias("node"), F.col("conv_id").alias("up"))
        if not kids.where((F.col("turns") > local_turns) & (F.col("members") > 1)).limit(1).count():
            break
        depth += 1
    rows = turns.join(small, "seq").where("pos >= depth")
    nodes = materialize(finished(rows.where("not lone").select("bucket", "depth", "up", "seq", "copies", "pos", "id", "words")).unionByName(lone_nodes(rows.where("lone"))))
    told, below = nodes.where("top").select("bucket", "n_leaves", "saved_tokens"), None
    for depth in range(len(levels) - 1, -1, -1):
        wide = levels[depth].where((F.col("turns") > local_turns) & (F.col("members") > 1))
        if below is not None:
            wide = materialize(_with_subtrees(wide, below.join(told, "bucket"), depth))
            told = told.unionByName(wide.select("bucket", "n_leaves", "saved_tokens"))
            nodes = nodes.unionByName(wide)
        below = levels[depth]
    return nodes.drop("bucket", "top")


def conversation_trie(turns: DataFrame, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; ``turns``: conv_id, turn, role, text.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    """
    rows = materialize(rebuilt(coded_turns(turns)))
    known, members = sequences(rows)
    nodes = trie(rows.withColumnRenamed("conv", "seq"), known, local_turns)
    told = nodes.where("end_copies > 1").join(end_digests(members), "end_seq")
    rest = nodes.where("end_copies is null or end_copies = 1").withColumn("ends", F.when(F.col("end_seq").isNotNull(), F.sha2(F.col("end_seq").cast("string").cast("binary"), 256)).otherwise(NO_DIGEST))
    return told.unionByName(rest).drop("end_seq", "end_copies").withColumnRenamed("ends", "ends_sha256")
