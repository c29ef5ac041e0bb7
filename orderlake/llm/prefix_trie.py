"""Conversation prefix trie (operator 13), by hashing blocks of turns first.

A node is a distinct sequence of first turns; its members are the conversations that start with it.

1. Turns get their place in the conversation by a range sort (``common.ranked``), and are known by a
   digest of role and text from then on.
2. A conversation is cut into blocks of ``BLOCK`` turns.  A block's digest is the hash of its turns',
   and the key of a prefix of whole blocks the xor of its blocks' digests, hashed with their numbers
   (128 bits), so prefixes of any length come from one scan (``_scan``).
3. Conversations are grouped by (block number, prefix before it, block digest): the coarse trie, with
   the smallest conversation and the number of members of each block.
4. Where a prefix goes on with one block only, the turns of that block are nodes as they are.  Only
   where sibling blocks diverge are their turns' in-block prefixes grouped, on the distinct blocks.
5. Sums over subtrees need no walk along the levels.  Every node is owned by its smallest member; a
   conversation owns the end of its path from some depth on.  What lies below a node is what its
   members own at its depth or deeper: its owner's part from there on (one scan) and all that its other members own.
   So each conversation's owned total is added up over blocks, and then over turns, as in 3 and 4.
6. Conversations that end at a node are hashed in order: packed into chunks of ids (at most
   4,096 each), and a task reads a node's chunks one at a time.

No task holds a conversation or a node's members: a hot conversation is ranked by ranges and scanned in
chunks, a hot prefix is aggregated in the tasks first, and the joins on parents leave hot ones
in place (``join_hot_apart``).

Cases: a null turn number comes first; turns that tie stand in order of their digests; repeated rows are turns
each; a null role or text is empty; rows without conversation id form no conversation; a conversation
without turns is a member of the root; an empty table has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.config import materialize
from orderlake.llm.common import join_hot_apart, ranked

BLOCK = 4
CHUNK = 4096
ROOT = "root"
REBUILD_EVERY, HEAD_LIMIT = 5, 9


def turn_digest(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def _key(*parts: Column) -> tuple[Column, Column]:
    """128 bits of the parts."""
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def _name(a: Column, b: Column) -> Column:
    return F.concat(F.hex(a), F.lit("-"), F.hex(b))


def _scan(rows: DataFrame, group: str, place: str, values: dict[str, str], fold: str, merge: Callable, down: bool = False,
          chunk: int = CHUNK) -> DataFrame:
    """Per value its fold over the group's earlier (``down``: later) rows, as ``values`` names it; 0 for none.

    A group is scanned ``chunk`` places at a time, after a scan over its chunks.
    """
    call = getattr(F, fold)
    rows = rows.withColumn("_chunk", F.expr(f"{place} div {chunk}"))
    sums = rows.groupBy(group, "_chunk").agg(*[call(v).alias(f"_{v}") for v in values])
    by = Window.partitionBy(group).orderBy(F.desc("_chunk") if down else F.asc("_chunk"))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    # A group's first chunk has nothing before it, and most groups have no other.
    base = (sums.select(group, "_chunk", *[call(f"_{v}").over(before).alias(f"_{v}") for v in values])
            .where(F.col(f"_{next(iter(values))}").isNotNull()))
    inside = (Window.partitionBy(group, "_chunk").orderBy(F.desc(place) if down else F.asc(place))
              .rowsBetween(Window.unboundedPreceding, -1))
    own = rows.select("*", *[F.coalesce(call(v).over(inside), F.lit(0)).alias(name) for v, name in values.items()])
    joined = own.join(base, [group, "_chunk"], "left")
    return joined.withColumns({name: merge(F.col(name), F.coalesce(F.col(f"_{v}"), F.lit(0)))
                               for v, name in values.items()}).drop("_chunk", *[f"_{v}" for v in values])


def ordered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Stored: c, pos (from 1), len, sha and bytes (of the text) of every turn; ``at`` orders conversations."""
    turns = materialize(
        rows.where(F.col(conv).isNotNull())
        .select(F.col(conv).alias("c"), F.col(turn).alias("t"), turn_digest(F.col(role), F.col(text)).alias("sha"),
                F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("bytes")), "turns")
    placed = ranked(turns, ["c"], ["t", "sha", "bytes"], "pos", "len", "at")
    return materialize(placed.withColumn("pos", F.col("pos") + 1).drop("t"), "ordered-turns")


def rebuilt(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Conversations with the head of another one: c's first h turns are those of conversation c - c % 5.

    Returns the turns c, pos, sha, bytes.  ``conversations``: c and len, stored.
    """
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % HEAD_LIMIT).alias("h")
    plan = conversations.select("c", (F.col("c") - F.col("c") % REBUILD_EVERY).alias("head"), h)
    heads = conversations.select(F.col("c").alias("head"), F.col("len").alias("head_len"))
    plan = plan.join(heads, "head", "left").withColumn("taken", F.least("h", F.coalesce("head_len", F.lit(0))))
    # At most HEAD_LIMIT - 1 turns of a head, each for a handful of conversations.
    lent = (turns.where(F.col("pos") < HEAD_LIMIT).withColumnRenamed("c", "head")
            .join(plan.where("head_len IS NOT NULL").select("c", "head", "h"), "head")
            .where("pos <= h").select("c", "pos", "sha", "bytes"))
    rest = (join_hot_apart(turns.select("c", "pos", "sha", "bytes"),
                           materialize(plan.join(conversations.select("c", "len"), "c").select("c", "h", "taken", "len"),
                                       "rebuild-plan"), "c", "len", "inner")
            .where("pos > h").select("c", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "sha", "bytes"))
    return lent.unionByName(rest)


def blocks(turns: DataFrame) -> DataFrame:
    """Stored: c, blk, turns (at most BLOCK), the prefix before (u1, u2) and the block's own id."""
    rows = (turns.withColumn("blk", F.expr(f"(pos - 1) div {BLOCK}")).withColumn("_c", F.expr(f"(pos - 1) div {BLOCK * CHUNK}"))
            .repartition("c", "_c")
            .groupBy("c", "_c", "blk").agg(F.sort_array(F.collect_list(F.struct("pos", "sha", "bytes"))).alias("turns")))
    shas = F.array_join(F.transform("turns", lambda t: t["sha"]), "")
    a, b = _key(F.col("blk"), F.sha2(shas.cast("binary"), 256))
    keyed = rows.select("c", "blk", "turns", a.alias("k1"), b.alias("k2"))
    scanned = _scan(keyed, "c", "blk", {"k1": "u1", "k2": "u2"}, "bit_xor", lambda p, q: p.bitwiseXOR(q))
    return materialize(scanned.select(
        "c", "blk", "turns", "u1", "u2", _name(F.col("u1").bitwiseXOR(F.col("k1")), F.col("u2").bitwiseXOR(F.col("k2")))
        .alias("block")), "blocks")


def _turn_ids() -> Column:
    """Per turn of a block: its node's id, its parent's, depth and bytes.

    After the last turn of a whole block the id is that of the prefix of whole blocks.
    """
    up = F.when(F.col("blk") == 0, F.lit(ROOT)).otherwise(_name(F.col("u1"), F.col("u2")))

    def node(j: Column) -> Column:
        shas = F.array_join(F.transform(F.slice("turns", 1, j.cast("int")), lambda t: t["sha"]), "")
        inner = _name(*_key(F.col("blk"), F.col("u1"), F.col("u2"), F.sha2(shas.cast("binary"), 256)))
        return F.when(j == 0, up).when(j == BLOCK, F.col("block")).otherwise(inner)

    return F.transform("turns", lambda t, i: F.struct(
        node(i + 1).alias("id"), node(i).alias("parent"), t["pos"].alias("depth"), t["bytes"].alias("bytes")))


def coarse(rows: DataFrame) -> DataFrame:
    """Stored: the distinct blocks with conv (smallest member), n (members) and whether siblings diverge."""
    grouped = materialize(rows.groupBy("blk", "u1", "u2", "block").agg(
        F.min("c").alias("conv"), F.count(F.lit(1)).alias("n"), F.first("turns").alias("turns")), "coarse")
    alone = (grouped.groupBy("blk", "u1", "u2").agg(F.count(F.lit(1)).alias("k"), F.min("block").alias("block"))
             .where("k = 1").select("block", F.lit(True).alias("alone")))
    return materialize(grouped.join(alone, "block", "left"), "coarse")


def refine(distinct: DataFrame, **sums: str) -> DataFrame:
    """The turn nodes of coarse blocks: id, parent, depth, bytes, conv, and ``sums`` of the blocks' columns."""
    every = distinct.select("conv", "alone", *sums.values(), F.explode(_turn_ids()).alias("t")).select(
        "conv", "alone", *sums.values(), "t.*")
    columns = ["id", "parent", "depth", "bytes", "conv"]
    straight = every.where("alone").select(*columns, *[F.col(v).alias(k) for k, v in sums.items()])
    split = every.where("alone IS NULL").groupBy("id").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("bytes").alias("bytes"),
        F.min("conv").alias("conv"), *[F.sum(v).alias(k) for k, v in sums.items()])
    return straight.unionByName(split.select(*columns, *sums))


def hash_ends(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) of the rows (id, c, at): SHA-256 of each id's c's in ascending order, comma-joined."""
    chunks = (ends.groupBy("id", F.shiftright("at", 12).alias("chunk"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != last:
                    if state is not None:
                        out.append((last, state.hexdigest()))
                    last, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["id", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([state.hexdigest()])], ["id", "ends_sha256"])

    return (chunks.repartition("id").sortWithinPartitions("id", "chunk").select("id", "ids")
            .mapInArrow(run, "id string, ends_sha256 string"))


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of conversations given by turns (c, pos from 1 without gaps, sha, bytes).

    ``conversations``, stored: every c, also those without turns, and ``at``, which grows with c.
    """
    rows = blocks(turns)
    distinct = coarse(rows)
    nodes = materialize(refine(distinct, n_convs="n"), "nodes")
    kids = materialize(nodes.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")), "children")

    # What each conversation owns: its part of the saved tokens, and a leaf if its path ends in one of its own.
    weighed = nodes.join(kids.withColumnRenamed("parent", "id"), "id", "left").select(
        "id", "conv", "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        F.col("n_children").isNull().cast("bigint").alias("leaf"))
    weighed = materialize(weighed, "weights")
    owned = materialize(weighed.groupBy("conv").agg(
        F.sum("saved").alias("own_saved"), F.sum("leaf").alias("own_leaves"), F.max("depth").alias("depth")), "owned")
    below = _scan(weighed, "conv", "depth", {"saved": "later"}, "sum", lambda p, q: p + q, down=True).select(
        "id", (F.col("saved") + F.col("later")).alias("from_here"))

    # Summed over members, by block and then by turn.  Conversations that own nothing add nothing.
    side = owned.select(F.col("conv").alias("c"), "own_saved", "own_leaves", F.col("depth").alias("rows"))
    parts = (join_hot_apart(rows.select("c", "block"), side, "c", "rows", "inner")
             .groupBy("block").agg(F.sum("own_saved").alias("s"), F.sum("own_leaves").alias("l")))
    summed = refine(distinct.join(parts, "block"), members_saved="s", n_leaves="l").select("id", "members_saved", "n_leaves")

    ends = materialize(rows.groupBy("c").agg(F.max_by(F.element_at(_turn_ids(), -1)["id"], "blk").alias("id"))
                       .join(conversations.select("c", "at"), "c", "right")
                       .select(F.coalesce("id", F.lit(ROOT)).alias("id"), "c", "at"), "ends")
    hashed = hash_ends(ends)
    nothing = hashlib.sha256(b"").hexdigest()

    totals = owned.agg(F.coalesce(F.sum("own_saved"), F.lit(0)).alias("saved_tokens"),
                       F.coalesce(F.sum("own_leaves"), F.lit(0)).alias("n_leaves"))
    root = (conversations.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
            .join(F.broadcast(totals))  # two single rows
            .select(F.lit(ROOT).alias("id"), F.lit(None).cast("string").alias("parent"), "conv_id",
                    F.lit(0).cast("bigint").alias("depth"), "n_convs",
                    F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved_tokens"))
    inner = (nodes.join(below, "id").join(summed, "id").join(owned.select("conv", "own_saved"), "conv")
             .select("id", "parent", F.col("conv").alias("conv_id"), "depth", "n_convs", "n_leaves",
                     (F.col("members_saved") - F.col("own_saved") + F.col("from_here")).alias("saved_tokens")))
    full = (root.unionByName(inner).join(kids.withColumnRenamed("parent", "id"), "id", "left")
            .join(hashed, "id", "left")
            .withColumns({"n_children": F.coalesce("n_children", F.lit(0)),
                          "ends_sha256": F.coalesce("ends_sha256", F.lit(nothing))}))
    full = materialize(full, "trie")
    parents = materialize(kids.join(full.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent"),
                          "parents")
    top = full.where(F.col("parent").isNull()).withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    found = join_hot_apart(full.where(F.col("parent").isNotNull()),
                           parents.withColumnRenamed("n_children", "_rows"), "parent", "_rows", "inner")
    return found.unionByName(top).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                         "saved_tokens", "ends_sha256")


def conversations_of(turns: DataFrame) -> DataFrame:
    """Stored: c, len and at of every conversation; ``at`` grows with c."""
    return materialize(turns.groupBy("c").agg(F.max("len").alias("len"), F.min("at").alias("at")), "conversations")


def prefix_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                rebuild: bool = False) -> DataFrame:
    """The trie of all conversations; with ``rebuild``, of conversations that share heads (``rebuilt``)."""
    turns = ordered_turns(rows, conv, turn, role, text)
    conversations = conversations_of(turns)
    own = rebuilt(turns, conversations) if rebuild else turns.select("c", "pos", "sha", "bytes")
    return trie(own, conversations)
