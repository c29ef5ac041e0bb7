"""Sharding (operator 3): a k-d tree over document metadata, split at weighted medians.

The dimensions of a document are its language, source, size and id, each as a whole
number of 62 bits: the value in the upper half, a shuffled rank of the document in the
lower half, so that equal values can be split too.  A node with n leaves to make is split
along the dimension in which it is widest (its range of values over that of the whole
table) into n // 2 and n - n // 2 leaves, at the quantile of its bytes in that proportion.

A quantile is found without sorting: the node's range is cut into ``BINS`` bins, one
grouped sum over the narrow metadata table weighs the bins of all nodes of a level, and the
bin in which the quantile lies is cut again, until one key is left.  The driver holds the
tree only (a few numbers per shard).  The law is ``bytes``: a split is off by at most half
a document, so shards differ by about one document's bytes.

Only DataFrame operations.  Texts are never shuffled to build the tree; the metadata table
(five numbers a document) is stored once in the shared folder.

Cases: a null text has no bytes and no crc32; null language, source or id are values of
their own.  Rows equal in id and text can't be told apart and stay in one shard.  An empty
table gives empty shards.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.config import materialize
from orderlake.llm.common import running_sum, spread

SHARDS = 40
ROW_BYTES = 16
BINS = 4096
_HALF = 31


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def text_crc32(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def _value31(column: Column) -> Column:
    """Equal values get equal numbers; null gets 0."""
    return F.when(column.isNull(), F.lit(0)).otherwise(
        F.shiftrightunsigned(F.xxhash64(column.cast("string")), 64 - _HALF)).cast("bigint")


def metadata(docs: DataFrame) -> list[Column]:
    """The keys of the four dimensions, from the columns doc_id, text, lang and source."""
    ids = docs.agg(F.min(F.col("doc_id").cast("double")), F.max(F.col("doc_id").cast("double"))).first()
    low, span = ids[0] or 0.0, max((ids[1] or 0.0) - (ids[0] or 0.0), 1.0)
    log_size = F.floor(F.log2(size_of(F.col("text")).cast("double")) * float(1 << 25)).cast("bigint")
    place = F.floor((F.col("doc_id").cast("double") - low) / span * float((1 << _HALF) - 1)).cast("bigint")
    tie = F.shiftright(spread(F.col("doc_id"), F.coalesce(text_crc32(F.col("text")), F.lit(-1))), 60 - _HALF)
    values = [_value31(F.col("lang")), _value31(F.col("source")), log_size, F.coalesce(place, F.lit(0))]
    return [v * F.lit(1 << _HALF) + tie for v in values]


@dataclass
class Tree:
    """Nodes in heap order: children of i are 2 i + 1 (keys up to the cut) and 2 i + 2."""

    leaves: dict[int, int]
    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    depth: int = 0

    def _lookup(self, values: dict[int, int], missing: int) -> Column:
        """A constant array with an entry for each node."""
        text = ",".join(str(values.get(i, missing)) for i in range((2 << self.depth) - 1))
        return F.split(F.lit(text), ",").cast("array<bigint>")

    def node(self, keys: list[Column]) -> Column:
        """The node that a document has reached."""
        if not self.splits:
            return F.lit(0)
        dims = self._lookup({i: d + 1 for i, (d, _) in self.splits.items()}, 0)
        cuts = self._lookup({i: c for i, (_, c) in self.splits.items()}, 0)
        own = F.array(*keys)

        def step(node, _):
            at = (node + 1).cast("int")
            dim = F.element_at(dims, at).cast("int")
            right = (F.element_at(own, dim) > F.element_at(cuts, at)).cast("int")
            return F.when(dim == 0, node).otherwise(node * 2 + 1 + right)

        return F.aggregate(F.sequence(F.lit(1), F.lit(max(self.depth, 1))), F.lit(0), step)

    def shard(self, keys: list[Column]) -> Column:
        """Leaves numbered from left to right."""
        numbers: dict[int, int] = {}
        stack = [0]
        while stack:
            i = stack.pop()
            if i in self.splits:
                stack += [2 * i + 2, 2 * i + 1]
            else:
                numbers[i] = len(numbers)
        return F.element_at(self._lookup(numbers, 0), (self.node(keys) + 1).cast("int")).cast("int")


def build_tree(points: DataFrame, keys: list[str], weight: str, shards: int) -> Tree:
    """Split until each leaf holds its part, 1/shards, of the weight.  ``points`` should be stored."""
    tree = Tree({0: shards})
    spans: list[float] = []
    while True:
        open_nodes = {i: n for i, n in tree.leaves.items() if n > 1}
        if not open_nodes:
            return tree
        at = tree.node([F.col(k) for k in keys]).alias("_node")
        stats = (points.select(at, *keys, weight).groupBy("_node")
                 .agg(F.sum(weight).alias("w"), *[f(k).alias(f"{n}_{k}") for k in keys
                                                  for n, f in (("lo", F.min), ("hi", F.max))]).collect())
        seen = {r["_node"]: r for r in stats}
        if not spans:
            spans = [max(1, (r[f"hi_{k}"] >> _HALF) - (r[f"lo_{k}"] >> _HALF)) for r in stats for k in keys]
        cuts: dict[int, dict] = {}
        for i, n in open_nodes.items():
            if (r := seen.get(i)) is None:
                tree.splits[i] = (0, 0)  # no document reaches it
                continue
            wide = [((r[f"hi_{k}"] >> _HALF) - (r[f"lo_{k}"] >> _HALF)) / s for k, s in zip(keys, spans)]
            dim = max(range(len(keys)), key=lambda d: (wide[d], -d))
            cuts[i] = {"dim": dim, "lo": r[f"lo_{keys[dim]}"], "hi": r[f"hi_{keys[dim]}"],
                       "goal": int(r["w"]) * (n // 2) / n, "below": 0}
        for i, (dim, cut) in _cut(points, tree, keys, weight, cuts).items():
            tree.splits[i] = (dim, cut)
        for i, n in open_nodes.items():
            del tree.leaves[i]
            tree.leaves |= {2 * i + 1: n // 2, 2 * i + 2: n - n // 2}
        tree.depth += 1


def _cut(points: DataFrame, tree: Tree, keys: list[str], weight: str,
         cuts: dict[int, dict]) -> dict[int, tuple[int, int]]:
    """For each open node, its dimension and the key at which its lower part's weight is nearest the goal."""
    done: dict[int, tuple[int, int]] = {}
    while cuts:
        step = {i: (c["hi"] - c["lo"]) // BINS + 1 for i, c in cuts.items()}

        def of(name: str) -> Column:
            return F.element_at(tree._lookup({i: c[name] for i, c in cuts.items()}, 0), (F.col("_node") + 1).cast("int"))

        rows = (points.select(tree.node([F.col(k) for k in keys]).alias("_node"), F.array(*keys).alias("_keys"),
                              F.col(weight).alias("_w"))
                .where(F.col("_node").isin(*cuts))
                .withColumn("_key", F.element_at("_keys", (of("dim") + 1).cast("int")))
                .where((F.col("_key") >= of("lo")) & (F.col("_key") <= of("hi"))))
        width = F.element_at(tree._lookup(step, 1), (F.col("_node") + 1).cast("int"))
        bins = (rows.withColumn("_bin", F.call_function("div", F.col("_key") - of("lo"), width))
                .groupBy("_node", "_bin")
                .agg(F.sum("_w").alias("w"), F.min("_key").alias("lo"), F.max("_key").alias("hi")))
        from pyspark.sql import Window
        upto = Window.partitionBy("_node").orderBy("_bin")
        goal = F.element_at(
            F.split(F.lit(",".join(repr(float(cuts[i]["goal"] - cuts[i]["below"])) if i in cuts else "0.0"
                                   for i in range((2 << tree.depth) - 1))), ",").cast("array<double>"),
            (F.col("_node") + 1).cast("int"))
        crossing = (bins.withColumn("upto", F.sum("w").over(upto))
                    .where((F.col("upto") >= goal) & (F.col("upto") - F.col("w") < goal)).collect())
        for r in crossing:
            c = cuts[r["_node"]]
            before = c["below"] + r["upto"] - r["w"]
            if r["lo"] == r["hi"]:
                nearer_with = abs(before + r["w"] - c["goal"]) <= abs(before - c["goal"])
                done[r["_node"]] = (c["dim"], r["lo"] if nearer_with else r["lo"] - 1)
            else:
                c |= {"lo": r["lo"], "hi": r["hi"], "below": before}
        cuts = {i: c for i, c in cuts.items() if i not in done}
    return done


def plan(docs: DataFrame, shards: int = SHARDS, target_bytes: int | None = None) -> Column:
    """The shard of a document as an expression over doc_id, text, lang and source.

    With ``target_bytes``, as many shards as leaves of that size need.
    """
    keys = metadata(docs)
    names = [f"k{i}" for i in range(len(keys))]
    points = materialize(docs.select(*[k.alias(n) for k, n in zip(keys, names)],
                                     size_of(F.col("text")).alias("w")), "kd-points")
    if target_bytes:
        shards = max(1, math.ceil((points.agg(F.sum("w")).first()[0] or 0) / target_bytes))
    return build_tree(points, names, "w", shards).shard(keys)


def slots(rows: DataFrame, shard: str, out: str) -> DataFrame:
    """Adds a place within the shard, from 0 without gaps.  Needs doc_id and text_crc32."""
    ordered = rows.withColumn("_order", spread(F.col("doc_id"), F.col("text_crc32"))).withColumn("_one", F.lit(1))
    return running_sum(ordered, shard, "_order", "_one", out).drop("_order", "_one")


def sharded(docs: DataFrame, shards: int = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """All columns of ``docs`` with shard and slot, laid out by shard (``_shard`` etc. where a name is taken)."""
    columns = docs.columns
    names = [n if n not in columns else f"_{n}" for n in ("shard", "slot")]
    keyed = docs.select(F.struct(*columns).alias("_row"), F.col("doc_id"), text_crc32(F.col("text")).alias("text_crc32"),
                        plan(docs, shards, target_bytes).alias("_shard"))
    return slots(keyed, "_shard", "_slot").select(
        *[F.col("_row")[c].alias(c) for c in columns], F.col("_shard").alias(names[0]), F.col("_slot").alias(names[1]))
