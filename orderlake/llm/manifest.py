"""Merkle manifest of a dataset (operator 11), with nested-interval labels.

Every document is a leaf: the SHA-256 of its fields, each as ``-`` if null, else as its length
in UTF-8 bytes, ``:`` and its value.  Per group (source) the leaves stand in order of their key
and get ranks from 0; a node of level l covers the ranks [lo, hi), 16^l of them (fewer at
the end), and is the hash of its children's digests.  Groups' top nodes (subroots), in order of
the groups, are the leaves of a like tree, whose top is the root.

* Levels are built upwards: one grouped hash a level, over a sixteenth of the rows each time.
* Ancestors are attached downwards: at each level the nodes meet the parents whose interval
  contains theirs, in a join on (group, bucket of the level's width).  A parent brings its
  children's intervals and its own path, so a join carries one row per parent and no leaf
  meets more than its level-1 node.
* Siblings are the parent's interval less the node's own: children that end at or before its
  start stand left of it, those that start at or after its end stand right.

No task holds a group: ranks come from a range sort (``common.ranked``), and all joins and groups
are on (group, bucket), at most 16 rows each.  The driver learns the largest group's size only,
which gives the number of levels.

Cases: a null group is a group of its own, before all others; null keys come first; rows with
equal keys stand in order of their leaf digests; equal rows are separate leaves, of which any may have any of
their ranks (they have equal digests).  A group of one leaf is its own subroot, and a single
subroot is the root.  An empty table has no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.config import materialize
from orderlake.llm.common import ranked

FANOUT = 16
EVERY_TAMPERED = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return digest(*[field(v) for v in values])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def tampered(doc_id: Column) -> Column:
    """Documents whose text the check of the proofs changes: 5 divides crc32(doc_id); none without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % EVERY_TAMPERED == 0, F.lit(False))


def group_key(group: Column) -> Column:
    """Never null, in the order of the groups with null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


@dataclass
class Tree:
    """``levels[l]``: g, n (the group's leaves), lo, hi, digest and, above the leaves, children."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """The top node of every group: g, n, lo, hi, level, digest."""
        out = None
        for level, nodes in enumerate(self.levels):
            top = (nodes.where((F.col("n") <= FANOUT ** level) & (F.col("n") > FANOUT ** level // FANOUT))
                   .select("g", "n", "lo", "hi", F.lit(level).alias("level"), "digest"))
            out = top if out is None else out.unionByName(top)
        return out


def _above(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of ``level`` from those of the level below, of groups that have several."""
    width = FANOUT ** level
    runs = (nodes.where(F.col("n") > width // FANOUT)
            .groupBy("g", F.expr(f"lo div {width}").alias("run"))
            .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")))
    lo = F.col("run") * width
    return runs.select("g", "n", lo.alias("lo"), F.least(lo + width, F.col("n")).alias("hi"), "children",
                       digest(F.array_join(F.transform("children", lambda c: c["digest"]), "")).alias("digest"))


def build_tree(leaves: DataFrame) -> Tree:
    """From stored leaves: g, n, lo (rank), hi, digest, and any columns of their own."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels = [leaves]
    while FANOUT ** (len(levels) - 1) < most:
        levels.append(materialize(_above(levels[-1], len(levels)), "merkle-level"))
    return Tree(levels)


def attach(nodes: DataFrame, parents: DataFrame, level: int) -> DataFrame:
    """``nodes`` of ``level`` - 1 with the path from them up: the digests left and right of them at each level."""
    bucket = F.expr(f"lo div {FANOUT ** level}")
    up = parents.select("g", bucket.alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                        F.col("children").alias("_children"), F.col("path").alias("_path"), "subroot")
    met = (nodes.withColumn("_bucket", bucket).join(up, ["g", "_bucket"])
           .where((F.col("lo") >= F.col("_lo")) & (F.col("hi") <= F.col("_hi"))))

    def digests(where) -> Column:
        return F.array_join(F.transform(F.filter("_children", where), lambda c: c["digest"]), "")

    step = F.struct(digests(lambda c: c["hi"] <= F.col("lo")).alias("left"),
                    digests(lambda c: c["lo"] >= F.col("hi")).alias("right"))
    return met.withColumn("path", F.concat(F.array(step), "_path")).drop(
        "_bucket", "_lo", "_hi", "_children", "_path")


def with_paths(tree: Tree, tops: DataFrame) -> DataFrame:
    """The leaves with path and subroot.  ``tops``: g, level, subroot and path (from there on) of every group."""
    above = None
    for level in range(len(tree.levels) - 1, -1, -1):
        nodes = tree.levels[level]
        at = nodes.join(tops.where(F.col("level") == level).select("g", "subroot", "path"), "g") if level else \
            nodes.where("n = 1").join(tops.where("level = 0").select("g", "subroot", "path"), "g")
        if level + 1 < len(tree.levels):
            inner = nodes.where(F.col("n") > FANOUT ** level)
            at = at.unionByName(attach(inner, above, level + 1))
        above = at
    return above


PATH = "array<struct<left:string,right:string>>"


def leaves_of(docs: DataFrame, group: str = "source", key: str = "doc_id", fields=FIELDS,
              changed: Column | None = None, changed_field: str = "text", change=lower_ascii) -> DataFrame:
    """Ranked leaves: key, g, n, lo, hi, digest, and ``shown``, the digest of what is shown for checking.

    ``shown`` is taken from the row as ``change`` makes it where ``changed`` holds.
    """
    own = leaf_digest([F.col(f) for f in fields])
    shown = own if changed is None else F.when(changed, leaf_digest(
        [change(F.col(f)) if f == changed_field else F.col(f) for f in fields])).otherwise(own)
    rows = materialize(docs.select(F.col(key), group_key(F.col(group)).alias("g"), own.alias("digest"),
                                   shown.alias("shown")), "merkle-leaves")
    placed = ranked(rows, ["g"], [key, "digest", "shown"], "lo", "n")
    return materialize(placed.withColumn("hi", F.col("lo") + 1), "merkle-ranked")


def manifest(leaves: DataFrame) -> DataFrame:
    """Per leaf: its columns, subroot, root and path (left and right siblings per level, up to the root)."""
    tree = build_tree(leaves)
    tops = materialize(tree.tops(), "merkle-subroots")
    # The subroots are the leaves of the tree over the groups.
    over = materialize(ranked(tops.select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"), ["g"], ["of"], "lo", "n")
                       .withColumn("hi", F.col("lo") + 1), "merkle-ranked")
    upper = build_tree(over)
    root = upper.tops().select("g", "level", F.col("digest").alias("subroot"), F.array().cast(PATH).alias("path"))
    paths = with_paths(upper, root).select(F.col("of").alias("g"), F.col("subroot").alias("root"), "path")
    seeds = materialize(tops.select("g", "level", F.col("digest").alias("subroot")).join(paths, "g"), "merkle-paths")
    # The root is one value, the same on every row; it goes down in front of the path.
    carried = seeds.withColumn("subroot", F.struct("subroot", "root")).drop("root")
    out = with_paths(tree, carried)
    return out.select(*[c for c in out.columns if c != "subroot"], "subroot.subroot", "subroot.root")


def proof(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda d, p: digest(p["left"], d, p["right"]))
