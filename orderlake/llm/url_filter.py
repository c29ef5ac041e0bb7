"""URL filters (operator 2): host and path rules, then a character language-model ratio.

Rules decide first.  The urls that they allow and block are the accepted and rejected examples
of two variable-order Markov models over the bytes of the url (A-Z lower-cased, without its
scheme): contexts of up to ``ORDER`` bytes, smoothed by Witten-Bell interpolation with the
shorter context, down to a uniform one.  A url without a rule is judged by the difference of the
models' log-likelihoods per byte against a calibrated threshold.

Counts cover every n-gram of every example but a held-out fifth (by hash); counting partial sums in
the tasks, so one hot url or host is one row per task.  The models stay in Spark: totals of each
context, then the chances of the n-grams, joined from one byte up; a context has at most 256 next
bytes and a shorter n-gram at most 256 longer ones, so no key is hot.  Only n-grams of urls to be
scored are carried on.  A url's score is the sum of the log-ratios of its windows of ``ORDER`` + 1
bytes.  The windows used most, up to ``FAST_WINDOWS`` of them, are broadcast; a url that has others
gets their ratios by a join, in the same order of summing, so the bound doesn't change a score.
Such a window has at most about 1/``FAST_WINDOWS`` of all uses, so the join has no hot key either.

The threshold is the one with the best balanced accuracy on the held-out fifth among those that
block at most ``MAX_FALSE_BLOCKS`` of its accepted urls, from a histogram of its scores (a fixed
number of bins).

Cases: a null url, or one without ``://``, has empty host and path and no rule; its text is judged
all the same (an empty one has score 0).  Without examples of both kinds, or without held-out ones,
the threshold is 0 and equal models give score 0, which is allowed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.config import materialize
from orderlake.llm import textbuf

ORDER = 4
# Windows whose ratios are broadcast: 16 bytes each.
FAST_WINDOWS = 200_000
USES_PER_DOUBLING = 8
HELD_OUT = 5
BINS_PER_UNIT = 200
MAX_FALSE_BLOCKS = 0.01
FLUSH_AT = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values: (rule, allowed).  A rule is a host, with its subdomains, and a path prefix.
RULES = (("org/", True), ("example.org/es/", False), ("example.org/en/1", False), ("com/fr/", True), ("com/de/", False))


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    parts = [F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2)]
    return F.translate(parts[0], UPPER, LOWER), parts[1]


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and whether it allows; null where none does."""
    rule, allowed = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for text, allow in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        rule, allowed = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(allow)).otherwise(allowed)
    return rule, allowed


def model_text(url: Column) -> Column:
    return F.translate(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), UPPER, LOWER)


def _bytes(text: str | None) -> str:
    """The UTF-8 bytes, one character each."""
    return (text or "").encode().decode("latin-1")


def gram_counts(examples: DataFrame, order: int = ORDER) -> DataFrame:
    """(accepted, gram, n) over ``examples`` (text, accepted): every run of up to order + 1 bytes.

    A null ``accepted`` is counted as a third kind.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in kept], pa.bool_()), pa.array([k[1].encode("latin-1") for k in kept], pa.binary()),
                 pa.array(list(kept.values()), pa.int64())], ["accepted", "gram", "n"])
            kept.clear()
            return rows

        for batch in batches:
            for text, accepted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = "\x00" * order + _bytes(text)
                for size in range(1, order + 2):
                    kept.update((accepted, s[i - size + 1:i + 1]) for i in range(order, len(s)))
                if len(kept) > FLUSH_AT:
                    yield flush()
        yield flush()

    return (examples.select("text", "accepted").mapInArrow(count, "accepted boolean, gram binary, n bigint")
            .groupBy("accepted", "gram").agg(F.sum("n").alias("n")))


@dataclass
class Markov:
    """Log-probability of each known n-gram's last byte, and of leaving each known context.

    One model in plain Python, which states what ``window_ratios`` computes for both in Spark.
    """

    known: dict[str, float]
    leave: dict[str, float]
    order: int

    @classmethod
    def of(cls, counts: dict[str, int], order: int) -> Markov:
        total: Counter = Counter()
        kinds: Counter = Counter()
        for gram, n in counts.items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        prob: dict[str, float] = {}
        for gram in sorted(counts, key=len):
            context = gram[:-1]
            shorter = prob.get(gram[1:], 1 / 256) if len(gram) > 1 else 1 / 256
            prob[gram] = (counts[gram] + kinds[context] * shorter) / (total[context] + kinds[context])
        return cls({g: math.log(p) for g, p in prob.items()},
                   {c: math.log(kinds[c] / (total[c] + kinds[c])) for c in total}, order)

    def log_likelihood(self, s: str) -> float:
        known, leave, total = self.known, self.leave, 0.0
        s = "\x00" * self.order + s
        for i in range(self.order, len(s)):
            for size in range(self.order + 1, 0, -1):
                p = known.get(s[i - size + 1:i + 1])
                if p is not None:
                    total += p
                    break
                total += leave.get(s[i - size + 1:i], 0.0)
            else:
                total += math.log(1 / 256)
        return total


def window_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(window, ratio, uses) of the windows in ``counts`` whose ``accepted`` is null, used so often.

    The ratio is the log of the accepted model's chance of the last byte over the rejected model's.
    """
    accepted = F.col("accepted")
    kinds = {"a": accepted, "r": ~accepted, "uses": accepted.isNull()}
    grams = counts.groupBy("gram").agg(*[F.sum(F.when(kind, F.col("n")).otherwise(0)).alias(k) for k, kind in kinds.items()])
    contexts = grams.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("context")).agg(
        *[F.sum(k).alias(f"{k}_total") for k in "ar"], *[F.count_if(F.col(k) > 0).alias(f"{k}_kinds") for k in "ar"],
        F.collect_list(F.when(F.col("uses") > 0, F.struct("gram", "a", "r", "uses"))).alias("used"))
    chances = materialize(contexts.select(*[f"{k}_{of}" for k in "ar" for of in ("total", "kinds")], F.explode("used").alias("u"))
                          .select("u.*", *[f"{k}_{of}" for k in "ar" for of in ("total", "kinds")]), "url-chances")

    def chance(k: str, shorter: Column) -> Column:
        total, kinds = F.col(f"{k}_total"), F.col(f"{k}_kinds")
        return F.when(total > 0, (F.col(k) + kinds * shorter) / (total + kinds)).otherwise(shorter)

    known = None
    for size in range(1, order + 2):
        level = chances.where(F.length("gram") == size)
        if known is None:
            level = level.withColumns({f"{k}_shorter": F.lit(1 / 256) for k in "ar"})
        else:
            shorter = known.select(F.col("gram").alias("shorter"), *[F.col(f"{k}_chance").alias(f"{k}_shorter") for k in "ar"])
            # One or two bytes: at most 65,536 rows.
            shorter = F.broadcast(shorter) if size <= 3 else shorter
            level = level.withColumn("shorter", F.expr("substring(gram, 2)")).join(shorter, "shorter")
        known = level.select("gram", "uses", *[chance(k, F.col(f"{k}_shorter")).alias(f"{k}_chance") for k in "ar"])
    return known.select(F.conv(F.hex("gram"), 16, 10).cast("bigint").alias("window"),
                        (F.log("a_chance") - F.log("r_chance")).alias("ratio"), "uses")


def windows_of(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The window that ends in each byte, zeros before its text, as an integer."""
    at, start = np.arange(len(data)), np.repeat(offsets[:-1], np.diff(offsets))
    out = np.zeros(len(data), np.int64)
    for back in range(order, -1, -1):
        out = (out << 8) | np.where(at - back >= start, data[np.maximum(at - back, 0)], 0)
    return out


@dataclass
class Windows:
    """Windows in ascending order, and their ratios."""

    keys: np.ndarray
    ratios: np.ndarray

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ratios (0 where not known) and whether they are known."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return np.where(known, self.ratios[at], 0.0), known


@dataclass
class Ratio:
    """``fast`` is broadcast; ``rare`` has all other windows (window, ratio), or is None if there are none."""

    fast: Windows
    rare: DataFrame | None
    order: int = ORDER
    threshold: float = 0.0


def load(ratios: DataFrame, order: int = ORDER) -> Ratio:
    """From stored (window, ratio, uses): the most used windows to the driver, by a histogram of uses."""
    bucket = F.floor(F.log2("uses") * USES_PER_DOUBLING)
    sizes = {r.b: r["count"] for r in ratios.groupBy(bucket.alias("b")).count().collect()}
    least, room = None, FAST_WINDOWS
    for b in sorted(sizes, reverse=True):
        room -= sizes[b]
        if room < 0:
            break
        least = b
    fast = ratios.where(F.lit(False) if least is None else bucket >= least).select("window", "ratio").toArrow()
    keys, values = (np.asarray(fast.column(i).to_numpy()) for i in (0, 1))
    order_of_keys = np.argsort(keys)
    rare = None if room >= 0 else ratios.where(F.lit(True) if least is None else bucket < least).select("window", "ratio")
    return Ratio(Windows(keys[order_of_keys], values[order_of_keys]), rare, order)


def score(df: DataFrame, ratio: Ratio, text: Column, out: str = "score") -> DataFrame:
    """``df`` with the score of ``text`` in ``out``, null where it is null.

    Its texts are among those whose windows ``ratio`` was trained for.
    """
    shared = df.sparkSession.sparkContext.broadcast((ratio.fast, ratio.order))

    def found(column: pa.Array):
        fast, order = shared.value
        for _, data, offsets in textbuf.chunks(column):
            keys = windows_of(data, offsets, order)
            yield offsets, keys, *fast.find(keys)

    def total(column: pa.Array, own: pa.Array | None = None) -> pa.Array:
        if own is not None:
            flat = own.flatten()
            keys, at = np.unique(flat.field("window").to_numpy(zero_copy_only=False), return_index=True)
            rest = Windows(keys, flat.field("ratio").to_numpy(zero_copy_only=False)[at])
        scores = [np.zeros(0)]
        for offsets, keys, ratios, known in found(column):
            if own is not None:
                ratios[~known] = rest.find(keys[~known])[0]
            size = np.diff(offsets)
            scores.append(np.bincount(np.repeat(np.arange(len(size)), size), ratios, len(size)) / np.maximum(size, 1))
        return pa.array(np.concatenate(scores), pa.float64())

    def total_alone(column: pa.Array) -> pa.Array:
        return total(column)

    def total_with(column: pa.Array, own: pa.Array) -> pa.Array:
        return total(column, own)

    def missing(column: pa.Array) -> pa.Array:
        lists = []
        for offsets, keys, _, known in found(column):
            lists += [np.unique(keys[a:b][~known[a:b]]) for a, b in zip(offsets[:-1], offsets[1:])]
        return pa.array(lists, pa.list_(pa.int64()))

    if ratio.rare is None:
        return df.withColumn(out, F.when(text.isNotNull(), F.arrow_udf(total_alone, "double")(text)))

    columns = [c for c in df.columns if c != out]
    rows = df.select(F.struct(*columns).alias("_row"), text.alias("_text"))
    rows = rows.withColumn("_rare", F.when(F.col("_text").isNotNull(), F.arrow_udf(missing, "array<bigint>")(F.col("_text"))))
    some = F.coalesce(F.size("_rare") > 0, F.lit(False))
    key = F.sha2(F.col("_text").cast("binary"), 256).alias("_key")
    texts = rows.where(some).select(key, "_rare").dropDuplicates(["_key"]).select("_key", F.explode("_rare").alias("window"))
    own = (texts.join(ratio.rare, "window").groupBy("_key")
           .agg(F.collect_list(F.struct("window", "ratio")).alias("_own")))
    alone = rows.where(~some).select("_row", F.when(F.col("_text").isNotNull(),
                                                    F.arrow_udf(total_alone, "double")(F.col("_text"))).alias("_score"))
    joined = rows.where(some).select("_row", "_text", key).join(own, "_key", "left").select(
        "_row", F.arrow_udf(total_with, "double")(F.col("_text"), F.col("_own")).alias("_score"))
    return alone.unionByName(joined).select(*[F.col("_row")[c].alias(c) for c in columns], F.col("_score").alias(out))


def _best_threshold(bins: list) -> float:
    """The middle of the widest range of scores with the best balanced accuracy (rejected below it)."""
    sums = {a: sum(r.n for r in bins if r.accepted == a) for a in (True, False)}
    if not all(sums.values()):
        return 0.0
    edges = sorted({r.bin for r in bins})
    at = {(r.bin, r.accepted): r.n for r in bins}
    below = {True: 0, False: 0}
    best, options = -1.0, []
    for i, edge in enumerate([*edges, edges[-1] + 1]):
        gain = below[False] / sums[False] - below[True] / sums[True]
        low = edges[i - 1] + 1 if i else edge
        if gain > best + 1e-12 and below[True] <= MAX_FALSE_BLOCKS * sums[True]:
            best, options = gain, []
        if abs(gain - best) <= 1e-12:
            options.append((edge - low, (edge + low) / 2))
        for a in below:
            below[a] += at.get((edge, a), 0)
    return max(options)[1] / BINS_PER_UNIT


def train(texts: DataFrame, order: int = ORDER) -> Ratio:
    """From rows (text, accepted); where ``accepted`` is null, the text is one to be scored."""
    held = F.col("accepted").isNotNull() & (F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0)
    counts = gram_counts(texts.select("text", F.when(~held, F.col("accepted")).alias("accepted")), order)
    ratios = materialize(window_ratios(counts, order), "url-windows")
    ratio = load(ratios, order)
    held_out = score(texts.where(held), ratio, F.col("text"))
    bins = (held_out.select("accepted", F.floor(F.col("score") * BINS_PER_UNIT).alias("bin"))
            .select("accepted", F.greatest(F.lit(-20 * BINS_PER_UNIT), F.least(F.lit(20 * BINS_PER_UNIT), "bin")).alias("bin"))
            .groupBy("accepted", "bin").agg(F.count(F.lit(1)).alias("n")).collect())
    ratio.threshold = _best_threshold(bins)
    return ratio


JUDGED = ("host", "path", "rule", "score", "verdict")


def judge(pages: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, score (null where a rule decides) and verdict.

    Where ``pages`` has a column of such a name, it stays and the new one has an underscore in front.
    """
    columns = pages.columns
    names = [n if n not in columns else f"_{n}" for n in JUDGED]
    rows = pages.select(F.struct(*columns).alias("_page"), F.col(url).alias("_url"))
    host, path = host_and_path(F.col("_url"))
    rule, allowed = matching_rule(host, path, rules)
    ratio = train(rows.select(model_text(F.col("_url")).alias("text"), allowed.alias("accepted")))
    scored = score(rows, ratio, F.when(rule.isNull(), model_text(F.col("_url"))))
    verdict = F.when(F.coalesce(allowed, F.col("score") >= ratio.threshold), F.lit("allow")).otherwise(F.lit("block"))
    new = [host, path, rule, F.col("score"), verdict]
    return scored.select(*[F.col("_page")[c].alias(c) for c in columns], *[c.alias(n) for c, n in zip(new, names)])
