"""Whole Arrow string columns as numpy: word bounds and word hashes, no per-word Python.

Texts are worked on as the UTF-8 bytes of an Arrow array, in chunks of whole
texts of about ``CHUNK_BYTES`` (one longer text is a chunk of its own), so the
memory of a task is set by the chunk and the longest single text.

A word is a run of bytes that ``table`` maps to non-zero; the mapped byte is the
normalised one (for example lower-cased), so equal normalised words have equal
hashes.  Word hash: polynomial over random 64-bit byte codes modulo 2^64, then
mixed; the hash of a word window is a polynomial over its word hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 20
# Of ``map_texts``, whose working arrays and results take some 40 bytes per byte of text.
MAP_CHUNK_BYTES = 1 << 18
SPACES = b" \t\n\x0b\x0c\r"

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_WINDOW_BASE = np.uint64(0xD6E8FEB86659FD93)
_CODES = np.random.default_rng(20240607).integers(1, 2**64, 256, dtype=np.uint64)
_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """Byte -> normalised byte; separators -> 0, and byte 0, if it is none, to 255 (which UTF-8 never has)."""
    table = np.arange(256, dtype=np.uint8)
    table[0] = 255
    if lower:
        table[65:91] += 32
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


SPACE_WORDS = byte_table(SPACES)
SPACE_WORDS_CASED = byte_table(SPACES, lower=False)
# Letters, digits and everything beyond ASCII.
ALNUM_WORDS = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (in place on a copy)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        step = np.full(max(n, 2 * len(_powers[kind])), _BASE if kind == "base" else _BASE_INV, np.uint64)
        step[0] = 1
        _powers[kind] = np.cumprod(step, dtype=np.uint64)
    return _powers[kind][:n]


def range_hashes(norm: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``norm[start:end]`` for each pair; zero bytes inside count as nothing."""
    sums = np.zeros(len(norm) + 1, np.uint64)
    codes = _CODES[norm]
    codes[norm == 0] = 0
    np.cumsum(codes * _power("base", len(norm)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("inverse", len(norm) + 1)[starts])


@dataclass
class Words:
    """Words of a chunk of texts; text d has the words first[d] .. first[d + 1] - 1."""

    norm: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return range_hashes(self.norm, self.starts, self.ends)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def room(self) -> np.ndarray:
        """Per word, how many words its text has from it on, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))

    def normalised(self, word: int, n: int) -> bytes:
        return b" ".join(self.norm[self.starts[i]:self.ends[i]].tobytes() for i in range(word, word + n))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive entries (runs across texts included; mask them by ``room``)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:m].copy()
    for j in range(1, n):
        out *= _WINDOW_BASE
        out += hashes[j:m + j]
    return mix(out)


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, data = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(bounds, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACE_WORDS) -> Words:
    norm = table[data]
    inside = norm != 0
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after[-1:], after[:-1] = False, inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    before[edge] = False
    after[edge - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(norm, starts, ends, np.searchsorted(starts, offsets))


def sums_by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, the sum of ``flags`` over its bytes (or other units that offsets count)."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def map_texts(df: DataFrame, text: str, kept: list[str], measure: Callable[[np.ndarray, np.ndarray], list[pa.Array]],
              fields: str) -> DataFrame:
    """Columns ``kept`` of ``df`` with ``fields``, which ``measure`` makes from the bytes and offsets of texts.

    For results as large as the texts: they leave the task a chunk at a time.
    """
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in chunks(batch.column(0), MAP_CHUNK_BYTES):
                own = [c.slice(row, len(offsets) - 1) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*own, *measure(data, offsets)], [*kept, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema] + [fields])
    return df.select(text, *kept).mapInArrow(run, schema)
