"""Mixing sources to target weights (operator 1): a time-varying curriculum.

Training time runs from 0 to 1.  Each source has a weight schedule, a straight line
between its weight at time 0 and at time 1.  Its integral, the mean of the two, sets the
source's share of the mix; a target stops at ``max_epochs`` times the source's size and
the excess goes to the others by weight.  Scaled to the target, the running integral is
the source's cumulative token demand D(t) = target * (a t + (b - a) t^2 / 2) / (a + b) * 2.

A source's documents stand in a repeatable shuffled order and repeat whole epochs until
the demand is met; the copy that crosses the target is cut there.  A copy that covers the
demand [from, to) is trained at the time when D reaches its middle: D is inverted in
closed form, and the copies of all sources are range-sorted by that time.

All of it is DataFrame work.  Only (id, source, size) is shuffled, never a text.  No task
holds a source (``running_sum``): a hot source is spread over its buckets.  The table of
sources is the one thing that is scanned in order as a whole.

Cases: a null text has size 0; a null source is a source of its own, after all others.
Documents of size 0 are never taken (``taken`` 0, no position).  An empty table gives an
empty result.  Rows equal in id, source and size are interchangeable copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import running_sum, spread

WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in code point order, repeating, and the mix's size.
WEIGHTS = (5, 2, 1)
MIX_SHARE = 1.5
MAX_EPOCHS = 2
# Schedule of each weight, as factors of it at time 0 and time 1 (mean 1): the heaviest
# sources come in more and more, the lightest fade out.
RAMPS = ((0.5, 1.5), (1.0, 1.0), (1.5, 0.5))
# Positions are whole numbers of this part of the training time.
TIME_STEPS = 1_000_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_schedules(sizes: DataFrame) -> DataFrame:
    """(source, source_size, w0, w1): sources ranked by code point, null last."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (rank % len(WEIGHTS) + 1).cast("int"))
    at = [F.element_at(F.array(*[F.lit(r[i]) for r in RAMPS]), (rank % len(RAMPS) + 1).cast("int")) for i in (0, 1)]
    return sources.select("source", "source_size", (weight * at[0]).alias("w0"), (weight * at[1]).alias("w1"))


def targets(schedules: DataFrame, mix_share: float = MIX_SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target``: words each source gives, its share by weight but at most its cap.

    With caps c and weights w, the shares are min(c, L * w) for one level L.  Sorted by
    c / w, the capped sources come first; L is what they leave over the weights of the rest.
    """
    weight = (F.col("w0") + F.col("w1")) / 2
    s = schedules.withColumn("_w", weight).withColumn("_cap", F.col("source_size").cast("double") * max_epochs)
    order = [F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("_level", (F.sum("source_size").over(everything) * F.lit(mix_share)
                                - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest))
    # The level is the one computed at the first source that it doesn't fill; later ones are lower.
    s = s.withColumn("_level", F.max(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"),
                                            F.col("_level"))).over(everything))
    return (s.withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap"))))
            .drop("_w", "_cap", "_level"))


def arrival(done: Column, target: Column, w0: Column, w1: Column) -> Column:
    """Time t at which the demand reaches ``done``: root of (w1 - w0) t^2 / 2 + w0 t = share * (w0 + w1) / 2."""
    need = done / target * ((w0 + w1) / 2)
    slope = w1 - w0
    return F.when(slope == 0, need / w0).otherwise(
        need * 2 / (w0 + F.sqrt(F.greatest(w0 * w0 + slope * need * 2, F.lit(0.0)))))


def plan(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
         mix_share: float = MIX_SHARE, max_epochs: int = MAX_EPOCHS, rows: bool = False) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, offset, w0, w1 and the words each epoch takes.

    With ``rows``, also the whole document as the struct ``_row``.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                        word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("_tie"),
                        *([F.struct(*docs.columns).alias("_row")] if rows else []))
    goals = (targets(source_schedules(sizes.select("source", "size")), mix_share, max_epochs)
             .withColumn("_group", group).drop("source"))
    placed = running_sum(
        sizes.withColumn("_group", group).withColumn("_order", spread(F.col("doc_id"), F.col("size"))),
        "_group", "_order", "size", "offset", ["doc_id", "size", "_tie"], goals)
    whole = F.floor("target")
    epochs = [F.greatest(F.lit(0), F.least(F.col("size"), whole - F.col("offset") - F.col("source_size") * e))
              for e in range(max_epochs)]
    return placed.drop("_group", "_order", "_tie").withColumn("epochs", F.array(*[e.cast("bigint") for e in epochs]))


def curriculum(planned: DataFrame) -> DataFrame:
    """Every document's copies with ``epoch``, ``words`` and ``position``, range-sorted by position.

    A document that is never taken stays as one row without epoch and position.
    """
    taken = F.filter("epochs", lambda w: w > 0)
    copies = planned.select("*", F.posexplode_outer(taken).alias("epoch", "words"))
    middle = F.col("offset") + F.col("source_size") * F.col("epoch") + F.col("words") / 2
    time = arrival(middle, F.col("target"), F.col("w0"), F.col("w1"))
    return (copies.withColumn("position", F.floor(time * TIME_STEPS).cast("bigint"))
            .orderBy("position", "source", "doc_id", "epoch"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, a row per copy with the columns of ``docs``, in order of training.

    A copy is a whole document here: it counts if the mix takes at least half of its words.
    """
    columns = docs.columns
    return (curriculum(plan(docs, rows=True)).where(F.col("words") * 2 >= F.col("size"))
            .select(*[F.col("_row")[c].alias(c) for c in columns]))
