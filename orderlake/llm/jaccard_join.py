"""N-gram Jaccard self-join (operator 10): rare-first prefix filtering, verified once per pair.

A document's set: the distinct five-word shingles of its lower-cased words, as 64-bit hashes
(a shorter text is one shingle).  Two documents link when 100 * |intersection| >= 80 * |union|.
Every link is found, none is expanded into copies:

1. Texts with equal sets are one class; from here on a class counts once.
2. Hash-ordered prefix, to find candidates cheaply: of its n shingles a class shows the
   n - ceil(0.8 n) + k(n) smallest hashes, k(n) = max(1, n // 10).  Two linked classes have min(k, k') of
   these in common (each prefix misses at most ceil(0.8 n) - k of the common shingles, and the common
   ones of both are the smallest of all common ones).  So a class with fewer than k(ceil(0.8 n)) shown
   shingles that any other class shows has no link and is out; that is most of a corpus.
3. Rare-first prefix: the whole sets of the candidates, sorted by the number of candidates that
   have a shingle.  s of a class's n shingles are shared with any other; it is out if s < ceil(0.8 n).
   Linked classes share one of the first n - ceil(0.8 n) + 1 (the n - s unshared ones come first).
   These are the postings.
4. A posting list is not paired off.  Every class is compared to the one leader (smallest
   class) that most of its lists have, then to its other leaders where they are in another
   component by then.  Two classes of one component need no comparison, so a group of m near copies
   costs about m comparisons.  What is left are lists with several components.
5. Classes near such a list's leader (similarity 0.4 or more) are joined by how they differ from it
   (``recentred``).  Two sets differ in |x + y - 2 xy| shingles, and so do their differences from the
   leader, so they link if their differences have enough in common: at least half of what both
   differences together exceed (n + m) / 9 by.  That is a prefix filter once more, on the
   differences, which are much smaller and rarer than the sets: copies that were edited
   apart, each on its own, meet nowhere.  Pairs that need nothing in common all link to the class
   with the most room, which stands for them and is compared first.  The lists of differences are not
   paired off either: in TURNS turns a class is compared to the one of its lists' leaders (LEADERS a list)
   that it is closest to by the shingles they meet at, and each turn's links join components before the next.
   Only then do the classes of a list that are still in different components meet, so most links
   of a dense group are never compared.
6. Other classes of a list, outside its main component, are compared to the list's classes in other
   components by then.  All pairs pass the length filter, the positional filter (the shared shingles from
   the common one on, in either class, reach the overlap that the two sizes need) and the suffix filter.
7. A pair is verified once, on the full sets, and the verified links give the components
   (``components``), by repeated steps of joins and grouped minima.

The suffix filter cuts the hash range at 63 fixed pivots; a pair's overlap is at most the sum
over the 64 parts of the smaller count.

Every table between steps is stored in the shared folder.  Hot shingles and classes are joined
apart (``join_hot_apart``); joins on hot leaders are left to Spark's splitting of skewed joins.  Cases: null or wordless texts have an empty set and link with nothing; equal
texts link; a document without id takes part, but can't be the smallest id; rows that share an
id are separate documents with that id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.config import drop_path, materialize, materialize_at
from orderlake.llm import textbuf
from orderlake.llm.common import bounded_semi_join, join_hot_apart, small_batches

SHINGLE_WORDS = 5
MIN_PERCENT = 80
PARTS = 64
# A class is near a leader if their sets differ in at most NEAR[0] / NEAR[1] of both sizes (similarity 0.4).
NEAR = 3, 7
# Turns in which each class near a leader is compared to one of its lists' leaders; what is left is compared in full.
TURNS = 2
# Leaders of such a list.
LEADERS = 8

_SECOND = np.uint64(0xA0761D6478BD642F)


def least_overlap(n):
    """ceil(0.8 n): shingles that a set of n shares with any set it links with."""
    return -(-n * MIN_PERCENT // 100)


def spare(n):
    """k(n): by how much the first prefix is longer than the shortest one that finds every link."""
    return np.maximum(1, n // 10)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per text its distinct shingle hashes in ascending order."""
    w = textbuf.words(data, offsets)
    words = w.hashes()
    windows = textbuf.window_hashes(words, size)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= size:
            h = np.sort(windows[a:b - size + 1])
            out.append(h[np.concatenate(([True], h[1:] != h[:-1]))])
        else:
            out.append(textbuf.window_hashes(words[a:b], b - a) if b > a else words[:0])
    return out


def _list_array(values: list[np.ndarray], kind) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values], dtype=np.int64))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind.to_pandas_dtype(), copy=False), kind))


def _class_key(h: np.ndarray) -> int:
    """Hash of a set from its sum and another sum; equal sets have equal keys."""
    n = np.uint64(len(h))
    a, b = h.sum(dtype=np.uint64), textbuf.mix(h ^ _SECOND).sum(dtype=np.uint64)
    return int(textbuf.mix(np.array([textbuf.mix(np.array([a + n]))[0] ^ b], np.uint64)).view(np.int64)[0])


def sign(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """n, class key and first prefix of each text."""
    sets = shingle_sets(data, offsets)
    shown = [h[:len(h) - least_overlap(len(h)) + int(spare(len(h)))].view(np.int64) for h in sets]
    return [pa.array([len(h) for h in sets], pa.int64()),
            pa.array([_class_key(h) if len(h) else None for h in sets], pa.int64()), _list_array(shown, pa.int64())]


def full(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """Class key, whole set and its counts in PARTS parts of the hash range."""
    sets = shingle_sets(data, offsets)
    parts = [np.bincount((h >> np.uint64(65 - PARTS.bit_length())).astype(np.int64), minlength=PARTS) for h in sets]
    return [pa.array([_class_key(h) if len(h) else None for h in sets], pa.int64()),
            _list_array([h.view(np.int64) for h in sets], pa.int64()), _list_array(parts, pa.int32())]


def _least(n: Column) -> Column:
    return F.ceil(n * MIN_PERCENT / 100).cast("bigint")


def _spare(n: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n / 10)).cast("bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of an edge (a, b): comp is the smallest node that it reaches.

    Alternates the two star operations: each node hands its larger neighbours, then itself and its
    smaller ones, to its smallest neighbour, until nothing changes; about log(n) rounds.  The result
    of each round is stored.
    """
    def hand_on(pairs: DataFrame, smaller: bool) -> DataFrame:
        least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        joined = pairs.join(least, "u")
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"), "u").where(
            F.lit(True) if smaller else F.col("a") > F.col("u")).drop("u")
        if smaller:
            moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return moved.where(F.col("a") != F.col("b")).distinct()

    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges, path = materialize_at(edges, "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
        before = state
        both = edges.selectExpr("a AS u", "b AS v").unionByName(edges.selectExpr("b AS u", "a AS v"))
        large, large_path = materialize_at(hand_on(both, smaller=False), "large-star")
        edges, new = materialize_at(
            hand_on(large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), smaller=True), "edges")
        drop_path(spark, path)
        drop_path(spark, large_path)
        path = new


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of all links so far: those that made ``comps`` (node, comp), which is stored, and ``links`` (a, b)."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    every = comps.unionByName(ends.join(comps, "node", "left_anti").withColumn("comp", F.col("node")))
    between = _with_comp(_with_comp(links, comps, "a", "_ca"), comps, "b", "_cb")
    moved = components(between.select(F.col("_ca").alias("a"), F.col("_cb").alias("b")))
    return _with_comp(every.withColumnRenamed("comp", "_old"), moved, "_old", "_new").select("node", F.col("_new").alias("comp"))


def attach(pairs: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
    """Stored (node, comp) with the links among the pairs (a, b)."""
    found = materialize(_linked(_may_link(pairs, sets), sets), "links")
    return comps if found.isEmpty() else materialize(merged(comps, found), "comps")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    x = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("_x"))
    y = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("_y"))
    common = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - common
    return (pairs.select("a", "b").join(x, "a").join(y, "b")
            .where(common * 100 >= union * MIN_PERCENT).select("a", "b"))


def _may_link(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Length and suffix filters on distinct pairs (a, b)."""
    x = sets.select(F.col("cls").alias("a"), F.size("shingles").alias("_nx"), F.col("parts").alias("_px"))
    y = sets.select(F.col("cls").alias("b"), F.size("shingles").alias("_ny"), F.col("parts").alias("_py"))
    most = F.aggregate(F.zip_with("_px", "_py", lambda p, q: F.least(p, q)), F.lit(0), lambda s, p: s + p)
    return (pairs.select("a", "b").distinct().join(x, "a").join(y, "b")
            .where((F.least("_nx", "_ny") >= _least(F.greatest("_nx", "_ny")))
                   & (most * 100 >= (F.col("_nx") + F.col("_ny") - most) * MIN_PERCENT)).select("a", "b"))


def _with_comp(rows: DataFrame, comps: DataFrame, key: str, name: str) -> DataFrame:
    return (rows.join(comps.select(F.col("node").alias(key), F.col("comp").alias("_c")), key, "left")
            .withColumn(name, F.coalesce("_c", key)).drop("_c"))


def _overlap(n: Column, m: Column) -> Column:
    """Shingles that sets of n and m have in common at least if they link: ceil(0.8 (n + m) / 1.8)."""
    return F.ceil((n + m) * MIN_PERCENT / (100 + MIN_PERCENT)).cast("bigint")


def candidates(reps: DataFrame) -> DataFrame:
    """Classes (cls) with enough shown shingles that other classes show too.  ``reps`` is stored."""
    shown = reps.select("cls", "n", F.explode("shown").alias("tok"))
    shared = materialize(shown.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    common = join_hot_apart(shown, shared, "tok", "df", "inner").groupBy("cls", "n").agg(F.count(F.lit(1)).alias("c"))
    return common.where(F.col("c") >= _spare(_least(F.col("n")))).select("cls")


def postings(sets: DataFrame) -> DataFrame:
    """Rare-first postings (tok, cls, n, rest): ``rest`` of the class's shared shingles stand from tok on."""
    every = sets.select("cls", F.size("shingles").cast("bigint").alias("n"), F.explode("shingles").alias("tok"))
    shared = materialize(every.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    # The hot join drops its count column, so the frequency travels twice.
    counted = join_hot_apart(every, shared.withColumn("freq", F.col("df")), "tok", "df", "inner")
    kept = (counted.groupBy("cls", "n").agg(F.sort_array(F.collect_list(F.struct("freq", "tok"))).alias("toks"))
            .withColumn("s", F.size("toks").cast("bigint")).where(F.col("s") >= _least(F.col("n"))))
    first = F.slice("toks", F.lit(1), (F.col("s") - _least(F.col("n")) + 1).cast("int"))
    return (kept.select("cls", "n", "s", F.posexplode(first).alias("_i", "_t"))
            .select(F.col("_t.tok").alias("tok"), "cls", "n", (F.col("s") - F.col("_i")).alias("rest")))


def find_components(posts: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, comp) of the classes that have links.  Both tables are stored."""
    lists = posts.groupBy("tok").agg(F.min("cls").alias("b"), F.count(F.lit(1)).alias("c")).where("c > 1")
    votes = materialize(posts.join(lists.drop("c"), "tok").where(F.col("cls") != F.col("b"))
                        .groupBy(F.col("cls").alias("a"), "b").agg(F.count(F.lit(1)).alias("votes")), "votes")
    first = votes.groupBy("a").agg(F.max_by("b", F.struct("votes", "b")).alias("b"))
    links = materialize(_linked(_may_link(first, sets), sets), "links")
    comps = materialize(components(links), "comps")

    others = _with_comp(_with_comp(votes.select("a", "b"), comps, "a", "_ca"), comps, "b", "_cb").where("_ca != _cb")
    comps = attach(others, comps, sets)

    near = recentred(mixed(posts, comps).select("lead", "cls").distinct(), sets)
    comps = join_near(near, comps, sets)
    # Elsewhere, what is outside the main component meets the others.
    marked = materialize(mixed(posts, comps).join(near.select("lead", "cls", F.lit(True).alias("near")),
                                                  ["lead", "cls"], "left"), "marked")
    x = marked.where("comp != main").select("tok", *[F.col(c).alias(f"x_{c}") for c in ("cls", "n", "rest", "comp", "near")])
    apart = (x.join(marked, "tok")
             .where((F.col("x_comp") != F.col("comp"))
                    & (F.col("x_near").isNull() | F.col("near").isNull())
                    & ((F.col("comp") == F.col("main")) | (F.col("x_cls") < F.col("cls")))
                    & (F.least("x_n", "n") >= _least(F.greatest("x_n", "n")))
                    & (F.least("x_rest", "rest") >= _overlap(F.col("x_n"), F.col("n"))))
             .select(F.col("x_cls").alias("a"), F.col("cls").alias("b")))
    return attach(apart, comps, sets)


def mixed(posts: DataFrame, comps: DataFrame) -> DataFrame:
    """Postings of the lists with several components, without their leaders (all were compared): also comp, main and lead."""
    placed = _with_comp(posts, comps, "cls", "comp")
    mains = (placed.groupBy("tok", "comp").agg(F.count(F.lit(1)).alias("c"), F.min("cls").alias("lead"))
             .groupBy("tok").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.min("lead").alias("lead"),
                                 F.count(F.lit(1)).alias("comps")).where("comps > 1").drop("comps"))
    return placed.join(mains, "tok").where("cls != lead")


def recentred(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Stored: lead, cls, n and ``diff``, the shingles that one of the two has, of classes near their leader.

    ``room``: n - 9 |diff|.  Two classes of a leader differ in at most (n + m) / 9 shingles, that is, they
    link, if their differences have -(room + room') / 18 shingles in common.
    """
    x = sets.select("cls", F.size("shingles").cast("bigint").alias("n"), F.col("shingles").alias("_x"))
    y = sets.select(F.col("cls").alias("lead"), F.col("shingles").alias("_y"))
    met = members.join(x, "cls").join(y, "lead").withColumn(
        "diff", F.concat(F.array_except("_x", "_y"), F.array_except("_y", "_x")))
    d = F.size("diff")
    return materialize(met.where(d * NEAR[1] <= (F.size("_x") + F.size("_y")) * NEAR[0])
                       .select("lead", "cls", "n", "diff", (F.col("n") - d * 9).alias("room")), "recentred")


def _needed(room: Column, other: Column) -> Column:
    """Shingles that the differences of two classes have in common at least if they link, and one."""
    return F.greatest(F.lit(1), F.ceil(-(room + other) / 18)).cast("bigint")


def join_near(near: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, comp) with the links between classes near one leader.  ``near`` and ``comps`` are stored."""
    leads = materialize(near.groupBy("lead").agg(F.max(F.struct("room", "cls")).alias("best"),
                                                 F.count(F.lit(1)).alias("members")), "leads")
    seen = materialize(join_hot_apart(near.select("lead", "cls", "n", "room"), leads, "lead", "members", "inner"),
                       "near-leads")
    # Whoever needs nothing in common with someone needs nothing in common with the class that has most room.
    roomy = (seen.where(F.col("room") + F.col("best.room") >= 0)
             .select(F.col("cls").alias("a"), F.col("best.cls").alias("b")))
    roomy = _with_comp(_with_comp(roomy, comps, "a", "_ca"), comps, "b", "_cb").where("_ca != _cb")
    comps = attach(roomy, comps, sets)
    posts = near_postings(near, seen)
    for turn in range(TURNS):
        before, comps = comps, attach(to_leaders(posts, comps, turn), comps, sets)
        if comps is before:
            break
    return attach(near_pairs(posts, comps), comps, sets)


def near_postings(near: DataFrame, seen: DataFrame) -> DataFrame:
    """Stored rare-first postings of the differences: a list (key) per leader and shingle.

    A hash collision would only make a list longer.
    """
    every = near.select("lead", "cls", F.explode("diff").alias("tok")).withColumn("key", F.xxhash64("lead", "tok"))
    shared = materialize(every.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    counted = join_hot_apart(every.select("lead", "cls", "key"), shared.withColumn("freq", F.col("df")), "key", "df", "inner")
    toks = (counted.groupBy("lead", "cls").agg(F.sort_array(F.collect_list(F.struct("freq", "key"))).alias("toks"))
            .join(seen, ["lead", "cls"])
            .withColumn("least", _needed(F.col("room"), F.col("best.room"))).withColumn("s", F.size("toks").cast("bigint"))
            .where("s >= least"))
    first = F.slice("toks", F.lit(1), (F.col("s") - F.col("least") + 1).cast("int"))
    return materialize(toks.select("lead", "cls", "n", "room", "s", F.posexplode(first).alias("_i", "_t"))
                       .select(F.col("_t.key").alias("key"), "lead", "cls", "n", "room",
                               (F.col("s") - F.col("_i")).alias("rest")), "near-postings")


def _meet(x: DataFrame, placed: DataFrame, when: Column) -> DataFrame:
    """Pairs (x_cls, cls) that may link of two sides' postings, with ``score``: the higher, the likelier they link.

    Two classes have in common at most the postings they meet at and what is left of either after the last.
    """
    x = x.select("key", *[F.col(c).alias(f"x_{c}") for c in ("cls", "comp", "n", "room", "rest")])
    fit = ((F.col("x_comp") != F.col("comp"))
           & (F.least("x_n", "n") >= _least(F.greatest("x_n", "n")))
           & (F.least("x_rest", "rest") >= _needed(F.col("x_room"), F.col("room"))))
    return (x.join(placed, "key").where(fit & when).withColumn("rooms", F.col("x_room") + F.col("room"))
            .groupBy("lead", "x_cls", "cls", "rooms", _needed(F.col("x_room"), F.col("room")).alias("least"))
            .agg(F.count(F.lit(1)).alias("c"), F.min(F.least("x_rest", "rest")).alias("rest"))
            .where(F.col("c") - 1 + F.col("rest") >= F.col("least"))
            .select("x_cls", "cls", (F.col("rooms") + F.col("c") * 18).alias("score")))


def _still_mixed(posts: DataFrame, comps: DataFrame) -> DataFrame:
    """Stored: the postings of the lists with several components, with comp and the list's main one."""
    placed = _with_comp(posts, comps, "cls", "comp")
    mains = (placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
             .groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"))
             .where("comps > 1").drop("comps"))
    return materialize(placed.join(mains, "key"), "near-mixed")


def to_leaders(posts: DataFrame, comps: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b), one at most for each class: that of its lists' leaders, in another component, which it is closest to.

    A list's classes are dealt out to LEADERS parts, each led by its roomiest class in turn 0 and by any in later turns.
    """
    placed = _still_mixed(posts, comps)
    order = F.col("room") if turn == 0 else F.xxhash64("cls", F.lit(-turn))
    leaders = (placed.groupBy("key", F.pmod(F.xxhash64("cls", F.lit(turn)), F.lit(LEADERS)).alias("_part"))
               .agg(F.max(F.struct(order.alias("order"), "cls", "comp", "n", "room", "rest")).alias("x"))
               .select("key", "x.*"))
    return (_meet(leaders, placed, F.col("comp") != F.col("main")).groupBy(F.col("cls").alias("a"))
            .agg(F.max_by("x_cls", F.struct("score", "x_cls")).alias("b")))


def near_pairs(posts: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes near a leader, still in different components, that may link."""
    placed = _still_mixed(posts, comps)
    # A pair within the main component needs no comparison, so one of the two is outside.
    x = placed.where("comp != main")
    return (_meet(x, placed, (F.col("comp") == F.col("main")) | (F.col("x_cls") < F.col("cls")))
            .select(F.col("x_cls").alias("a"), F.col("cls").alias("b")))


def _placed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``near_duplicates`` with the class (cls) of each document that has words, and its component (comp)."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed, signed_path = materialize_at(
        textbuf.map_texts(rows, "text", ["doc_id"], sign, "n bigint, cls bigint, shown array<bigint>"), "signed")
    members = materialize(signed.select("doc_id", "n", "cls"), "members")
    reps, reps_path = materialize_at(
        signed.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.first("shown").alias("shown")), "reps")
    drop_path(spark, signed_path)
    classes = materialize(members.where("n > 0").groupBy("cls")
                          .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("docs")), "classes")
    wanted = materialize(candidates(reps).join(classes, "cls").select("cls", "rep"), "candidates")
    drop_path(spark, reps_path)
    chosen = bounded_semi_join(rows, wanted.select("rep"), "doc_id", "rep")
    sets = (textbuf.map_texts(chosen, "text", [], full, "cls bigint, shingles array<bigint>, parts array<int>")
            .join(wanted.select("cls"), "cls", "left_semi")
            .groupBy("cls").agg(F.first("shingles").alias("shingles"), F.first("parts").alias("parts")))
    sets = materialize(sets, "sets")
    comps = materialize(find_components(materialize(postings(sets), "postings"), sets), "comps")

    placed = classes.join(comps, classes["cls"] == comps["node"], "left").drop("node")
    smallest = placed.where("comp IS NOT NULL").groupBy("comp").agg(F.min("rep").alias("least"))
    placed = placed.join(smallest, "comp", "left").select("cls", "docs", F.coalesce("least", "rep").alias("component_id"),
                                                         F.coalesce("comp", "cls").alias("comp"))
    found = join_hot_apart(members.where("n > 0"), materialize(placed, "placed"), "cls", "docs", "inner")
    empty = members.where("n = 0").withColumns({"component_id": F.col("doc_id"), "comp": F.lit(None).cast("bigint")})
    return found.unionByName(empty).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "cls", "comp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    return _placed(docs, doc_id, text).select("doc_id", "n_shingles", "component_id")


def class_of(text: Column) -> Column:
    """The class key of each text, null if it is wordless."""

    def run(column: pa.Array) -> pa.Array:
        sets = (h for _, data, offsets in textbuf.chunks(column) for h in shingle_sets(data, offsets))
        return pa.array([_class_key(h) if len(h) else None for h in sets], pa.int64())

    return F.arrow_udf(run, "bigint")(text)


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one of each group of near copies (that with the smallest id), columns unchanged.

    Wordless documents and documents without id stay.  Rows that share an id are told apart by their
    class: a group keeps one row of one class that has its smallest id, whatever other texts have that id.
    """
    found = materialize(_placed(docs, "doc_id", "text").where("n_shingles > 0 AND doc_id IS NOT NULL"), "near-duplicates")
    chosen = materialize(found.where(F.col("doc_id") == F.col("component_id")).groupBy("comp")
                         .agg(F.min("cls").alias("_cls"), F.min("doc_id").alias("_id")), "chosen")
    gone = materialize(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
                       .join(chosen, F.col("doc_id") == F.col("_id"), "left_anti"), "gone")
    twice = materialize(found.groupBy("doc_id").count().where("count > 1").select("doc_id")
                        .join(gone, "doc_id", "left_anti"), "repeated-ids")
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"),
                       F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("_wordy"))
    stay = bounded_semi_join(rows, gone, "_id", "doc_id", wanted=False, unless=~F.col("_wordy"))
    if not twice.isEmpty():
        single = bounded_semi_join(stay, twice, "_id", "doc_id", wanted=False, unless=~F.col("_wordy"))
        again = bounded_semi_join(stay.where("_wordy"), twice, "_id", "doc_id")
        again = again.withColumn("_cls", class_of(F.col("_text")))
        first = (again.withColumn("_k", F.row_number().over(Window.partitionBy("_id", "_cls").orderBy(F.xxhash64("_text"))))
                 .where("_k = 1").join(chosen, ["_id", "_cls"], "left_semi").select(*stay.columns))
        stay = single.unionByName(first)
    return stay.select(*[F.col("_row")[c].alias(c) for c in columns])
