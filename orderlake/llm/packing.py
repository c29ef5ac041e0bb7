"""Packing (operator 12): token sequences filled with lexical neighbours from a sharded BM25 index.

1. Tasks tokenize whole texts, word by distinct word (``Encoder``), and end each with the end id.  As
   many whole windows as a document fills are sequences of their own; what is left, its tail
   (shorter than a window), goes on with a signature: the first of its token ids by two weighted
   min-hashes.  Each task also counts, per token id, the tails that have it; summed, that is the document
   frequency over all tails (a table as long as the vocabulary), which every shard scores with.
2. Tails are sorted by range of their signatures, so that neighbours tend to stand together, and
   rows that tie are dealt out by a salt.  Consecutive tails make shards of at most ``SHARD_TOKENS`` tokens,
   whatever the partitions: a task holds one shard at a time.
3. A shard is an inverted index: per token id its postings (tail, BM25 weight).  The first
   unused tail is the seed of a window; its ids' postings are summed to scores, and unused
   neighbours fill the window best first, ties in order of the shard.  The last one is cut where the window is full,
   and its rest is the next seed.  Where no neighbour is left, the next tails follow in order.
4. The last window of a shard, if not full, is cut into sequences as long as powers of two, so no
   sequence needs padding.

Every id of every document lies in one piece.  Sequence ids are unique, not dense: they name the task and
the window in it.  The tables between the steps are stored; token ids are kept in two bytes each where
the vocabulary allows.

Cases: a null or empty text has the end id only; equal texts are separate documents; rows that
share an id, or have none, are packed each; an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.config import materialize
from orderlake.llm import textbuf

WINDOW = 2048
END_ID = 1
# Tokens of a shard: some 500 tails of medium length, a few megabytes of index.
SHARD_TOKENS = 1 << 18
# A range partition holds at most about so many shards (8 MB of ids).
SHARDS_A_TASK = 16
# Beyond so many partitions they grow instead.
MOST_TASKS = 100_000
# Lower-case words of Latin-1 letters.
PLAIN = re.compile("[a-zß-öø-ÿ]+")
# Marks that the tokenizer parts from letters (an apostrophe may begin a suffix, so it is none).
MARKS = b".,;:!?"
# Words whose ids a task remembers; it forgets them all when there are more.
REMEMBERED = 3 << 18
# Texts are tokenized about so many bytes at a time.
CHUNK_BYTES = 4 << 20
# BM25's usual constants.
K1, B = 1.2, 0.75

PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint"

class Encoder:
    """Token ids of texts with a vocabulary whose tokens never span white space.

    A text's ids are then the ids of its words one after the other, so each distinct word of a chunk is
    encoded once, and remembered for later chunks.
    """

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # How byte-level tokens write bytes: printable Latin-1 as itself, the others from U+0100 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.as_text = dict(zip([b for b in range(256) if b not in shown], range(256, 512)))
        self.size = max(self.tokenizer.get_vocab_size(), END_ID + 1)
        every = np.arange(self.size)
        self.rarity = [-np.log(_hash(every, seed)) for seed in (1, 2)]
        self.forget()

    def forget(self) -> None:
        # Word -> its number; the ids of word i are flat[bounds[i]:bounds[i + 1]].
        self.known: dict[str, int] = {}
        self.flat, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of lower-case words.

        The tokenizer's rules leave a word of plain letters as it is, so the merges alone give its ids;
        all other words go through the whole tokenizer.
        """
        plain = [PLAIN.fullmatch(w) is not None for w in words]
        other = iter(self.tokenizer.encode_batch_fast([w for w, p in zip(words, plain) if not p], add_special_tokens=False))
        merge = self.tokenizer.model.tokenize
        return [[t.id for t in merge(w if w.isascii() else w.encode().decode("latin-1").translate(self.as_text))] if p
                else next(other).ids for w, p in zip(words, plain)]

    def words(self, words: list[str]) -> np.ndarray:
        """The numbers of distinct words."""
        if len(self.known) > REMEMBERED:
            self.forget()
        found = list(map(self.known.get, words))
        new = [w for w, i in zip(words, found) if i is None]
        if new:
            ids = self.encode(new)
            numbers = range(len(self.known), len(self.known) + len(new))
            self.known.update(zip(new, numbers))
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())))
            self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(lengths))
            fresh = iter(numbers)
            found = [next(fresh) if i is None else i for i in found]
        return np.array(found, np.int64)

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk's texts, each with END_ID behind, and their bounds."""
        w = textbuf.words(data, offsets)  # lower-cased as far as ASCII, as the tokenizer would
        n = len(offsets) - 1
        # The tokenizer parts letters from these marks too, so "word" and "word," share their ids.
        cut = part(w.norm)
        inside = w.norm != 0
        first_byte = cut & inside
        first_byte[w.starts] = True
        starts = np.flatnonzero(first_byte)
        letters = w.norm[inside]
        letters[letters == 255] = 0  # byte 0 as it was
        place = np.cumsum(inside) - inside
        bounds = np.append(place[starts], len(letters)).astype(np.int64)
        column = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(letters))
        distinct = column.dictionary_encode()
        numbers = self.words(distinct.dictionary.to_pylist())
        at = numbers[distinct.indices.to_numpy(zero_copy_only=False)]
        # Every text's words and then, as one more word, the end id.
        flat = np.append(self.flat, np.uint32(END_ID))
        ends = np.searchsorted(starts, offsets[1:]) + np.arange(n)
        own = np.ones(len(at) + n, bool)
        own[ends] = False
        start, length = np.full(len(own), len(flat) - 1, np.int64), np.ones(len(own), np.int64)
        start[own], length[own] = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        stop = np.cumsum(length)
        kind = np.int32 if len(stop) and max(stop[-1], len(flat)) < 1 << 31 else np.int64
        out = flat[np.repeat((start - (stop - length)).astype(kind), length) + np.arange(stop[-1] if len(stop) else 0, dtype=kind)]
        return out, np.concatenate(([0], stop[ends]))

    def signature(self, terms: np.ndarray, counts: np.ndarray) -> tuple[int, int]:
        """Two ids drawn by min-hash, an id used n times being n times as likely."""
        return tuple(int(terms[np.argmin(r[terms] / counts)]) for r in self.rarity)


@lru_cache(maxsize=1)
def encoder(vocabulary: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(vocabulary)


_LETTER, _MARK = 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[97:123] = _LETTER
_KINDS[np.frombuffer(MARKS, np.uint8)] = _MARK


def part(norm: np.ndarray) -> np.ndarray:
    """True for the bytes at which a mark follows a letter or a letter a mark (letters a-z and U+00C0 to U+00FF)."""
    kinds = _KINDS[norm]
    # Two-byte letters: 0xC3 and a second byte, but for the signs U+00D7 and U+00F7.
    lead = np.flatnonzero(norm[:-1] == 0xC3)
    lead = lead[(norm[lead + 1] != 0x97) & (norm[lead + 1] != 0xB7)]
    kinds[lead] = kinds[lead + 1] = _LETTER
    cut = np.zeros(len(norm), bool)
    cut[1:] = kinds[1:] + kinds[:-1] == _LETTER + _MARK
    cut[1:] &= (kinds[1:] != 0) & (kinds[:-1] != 0)
    return cut


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _hash(ids: np.ndarray, seed: int) -> np.ndarray:
    """In (0, 1], the same for an id everywhere."""
    h = textbuf.mix(ids.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    return ((h >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)


@dataclass
class Vocabulary:
    """The text of a tokenizers file; broadcast, it is a few megabytes."""

    text: str

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(f.read())

    @property
    def id_type(self) -> np.dtype:
        from tokenizers import Tokenizer

        size = Tokenizer.from_str(self.text).get_vocab_size()
        return np.dtype("<u2") if max(size, END_ID + 1) <= 1 << 16 else np.dtype("<u4")


def tokenized(docs: DataFrame, key: str, text: str, vocabulary: Vocabulary, window: int) -> DataFrame:
    """Stored rows of three kinds: ``full`` windows, ``tail`` ids, and each task's ``seen`` counts."""
    spark = docs.sparkSession
    words, id_type = spark.sparkContext.broadcast(vocabulary.text), vocabulary.id_type
    key_type = docs.schema[key].dataType.simpleString()
    fields = f"`{key}` {key_type}, kind string, n bigint, start bigint, crcs array<bigint>, ids binary, s1 bigint, s2 bigint"
    names = [key, "kind", "n", "start", "crcs", "ids", "s1", "s2"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64()]

    def batch(keys: pa.Array, columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, *[pa.array(c, t) for c, t in zip(columns, types)]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(words.value)
        seen, kind = np.zeros(own.size, np.int64), None
        for b in batches:
            kind = b.column(1).type
            for row, data, offsets in textbuf.chunks(b.column(0), CHUNK_BYTES):
                keys = b.column(1).slice(row, len(offsets) - 1)
                ids, bounds = own.texts(data, offsets)
                out, at = [[] for _ in types], []
                for i, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    full = (z - a) // window * window
                    if full:
                        sums = [crc(ids[a + s:a + s + window]) for s in range(0, full, window)]
                        at.append(i)
                        for c, v in zip(out, ("full", z - a, 0, sums, None, None, None)):
                            c.append(v)
                    if z - a > full:
                        tail = ids[a + full:z]
                        terms, counts = np.unique(tail, return_counts=True)
                        seen[terms] += 1
                        at.append(i)
                        for c, v in zip(out, ("tail", z - a, full, None, tail.astype(id_type).tobytes(),
                                              *own.signature(terms, counts))):
                            c.append(v)
                yield batch(keys.take(pa.array(at, pa.int64())), out)
        if seen.any():  # (id, tails that have it) as two rows of numbers
            table = np.array([seen.nonzero()[0], seen[seen.nonzero()]], "<i8")
            yield batch(pa.nulls(1, kind), [["seen"], [None], [None], [None], [table.tobytes()], [None], [None]])

    return materialize(docs.select(text, key).mapInArrow(run, fields), "tokens")


def frequencies(rows: DataFrame) -> dict[int, int]:
    """Tails that have a token id, over all tails; as many entries as the vocabulary has ids at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                ids, counts = np.frombuffer(x, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts)], ["id", "n"])

    counted = rows.where("kind = 'seen'").select("ids").mapInArrow(run, "id bigint, n bigint")
    return {r.id: r.n for r in counted.groupBy("id").agg(F.sum("n").alias("n")).collect()}


class Shard:
    """The inverted index of some tails, and which of them are unused."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float):
        self.tails = tails
        found = [np.unique(ids, return_counts=True) for ids in tails]
        self.terms = [t for t, _ in found]
        every, tf = np.concatenate(self.terms), np.concatenate([n for _, n in found])
        kinds = np.array([len(t) for t in self.terms])
        length = np.repeat([len(ids) / mean for ids in tails], kinds)
        weights = idf[every] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length))
        order = np.argsort(every, kind="stable")
        self.docs, self.weights = np.repeat(np.arange(len(tails)), kinds)[order], weights[order]
        self.bounds = np.searchsorted(every[order], np.arange(len(idf) + 1))
        self.unused = np.ones(len(tails), bool)

    def neighbours(self, seed: int) -> Iterator[int]:
        """Unused tails, best first: those that share ids with the seed by score, then the rest in order."""
        t = self.terms[seed]
        spans = [(a, z) for a, z in zip(self.bounds[t].tolist(), self.bounds[t + 1].tolist())]
        docs = np.concatenate([self.docs[a:z] for a, z in spans])
        weights = np.concatenate([self.weights[a:z] for a, z in spans])
        scores = np.bincount(docs, weights, len(self.tails))
        scores[~self.unused] = -1.0
        yield from (d for d in np.argsort(-scores, kind="stable").tolist() if self.unused[d])


def pack_shard(tails: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (tail, start in it, length); every sequence is full or as long as a power of two."""
    shard = Shard(tails, idf, mean)
    pieces, room, rest, first = [], window, None, 0
    while True:
        if rest is not None:  # what a full window cut off
            seed, start = rest
        else:
            while first < len(tails) and not shard.unused[first]:
                first += 1
            if first == len(tails):
                break
            seed, start = first, 0
            shard.unused[seed] = False
        rest, found = None, None
        d = seed
        while d is not None:
            take = min(room, len(tails[d]) - start)
            pieces.append((d, start, take))
            room -= take
            if not room:
                yield pieces
                if start + take < len(tails[d]):
                    rest = (d, start + take)
                pieces, room = [], window
                break
            found = shard.neighbours(seed) if found is None else found
            d, start = next(found, None), 0
            if d is not None:
                shard.unused[d] = False
    yield from powers_of_two(pieces)


def powers_of_two(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces cut into sequences whose lengths are the powers of two that their sum has."""
    total = sum(n for *_, n in pieces)
    left = list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        room, sequence = total & (1 << bit), []
        while room:
            d, start, n = left.pop()
            take = min(room, n)
            sequence.append((d, start, take))
            if take < n:
                left.append((d, start + take, n - take))
            room -= take
        if sequence:
            yield sequence


def pack(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """A row per piece: the document's key, start, length, ids_crc32, doc_tokens, sequence_id and offset."""
    spark: SparkSession = docs.sparkSession
    rows = tokenized(docs, key, text, vocabulary, window)
    df = frequencies(rows)
    id_type = vocabulary.id_type
    size = (max(df) if df else 0) + 1
    tails = rows.where("kind = 'tail'").select(key, "n", "start", "ids", "s1", "s2")
    totals = tails.agg(F.count(F.lit(1)), F.sum(F.octet_length("ids"))).first()
    count, tokens = totals[0], (totals[1] or 0) // id_type.itemsize
    counts = np.zeros(size)
    for t, n in df.items():
        counts[t] = n
    idf = spark.sparkContext.broadcast(np.log1p((count - counts + 0.5) / (counts + 0.5)))
    mean = tokens / max(count, 1)

    key_type = docs.schema[key].dataType.simpleString()
    fields = f"`{key}` {key_type}, {PIECES}"
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def done() -> pa.RecordBatch:
            nonlocal made
            ids = [np.frombuffer(h[3], id_type) for h in held]
            at, out = [], [[] for _ in names[1:]]
            for sequence in pack_shard(ids, idf.value, mean, window):
                offset = 0
                for d, start, n in sequence:
                    at.append(d)
                    values = (held[d][2] + start, n, crc(ids[d][start:start + n]), held[d][1], (task << 32) + made, offset)
                    for c, v in zip(out, values):
                        c.append(v)
                    offset += n
                made += 1
            keys = pa.array([h[0] for h in held], kind).take(pa.array(at, pa.int64()))
            return pa.RecordBatch.from_arrays([keys, *[pa.array(c, pa.int64()) for c in out]], names)

        kind = pa.null()
        for b in batches:
            kind = b.column(0).type
            for row in zip(*[c.to_pylist() for c in b.columns]):
                n = len(row[3]) // id_type.itemsize
                if held and size + n > shard_tokens:
                    yield done()
                    held, size = [], 0
                held.append(row)
                size += n
        if held:
            yield done()

    order = ["s1", "s2", "salt"]
    parts = max(1, min(-(-tokens // (shard_tokens * SHARDS_A_TASK)), MOST_TASKS),
                min(count, spark.sparkContext.defaultParallelism))
    packed = (tails.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
              .repartitionByRange(int(parts), *order).sortWithinPartitions(*order)
              .select(key, "n", "start", "ids").mapInArrow(run, fields))
    # Whole windows: numbered by themselves, apart from the others by a high bit.
    full = rows.where("kind = 'full'").select(key, "n", F.posexplode("crcs").alias("_i", "crc"))
    numbered = full.withColumn("sequence_id", F.lit(1 << 62) + F.monotonically_increasing_id())
    whole = numbered.select(key, (F.col("_i").cast("bigint") * window).alias("start"), F.lit(window).cast("bigint").alias("length"),
                            F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "sequence_id",
                            F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(whole)
