"""Words of many texts at once, as positions in one byte array.

Separators are ASCII, so words are found in the UTF-8 bytes and texts need not be decoded. All steps
are array operations on slices of a few megabytes, whatever the length of an Arrow batch.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

SLICE_BYTES = 2 << 20
HASH_BYTES = 512 << 10
BATCH_ROWS = 1000
U = np.uint64


def small_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches of at most ``BATCH_ROWS`` rows: texts and sets of shingles are long, and a batch is held whole."""
    if int(spark.conf.get(ARROW_ROWS)) > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    return spark


def whole_id(table: DataFrame, column: str) -> Column:
    """An id column as a long. Other types are refused: a cast would end in an error or in nulls far from here."""
    kind = table.schema[column].dataType
    if not isinstance(kind, (T.IntegralType, T.NullType)):
        raise TypeError(f"{column} must be a whole number, not {kind.simpleString()}")
    return F.col(column).cast("long")


def _table(separators: bytes) -> np.ndarray:
    out = np.ones(256, dtype=bool)
    out[list(separators)] = False
    return out


#: [^\x20\x09-\x0D]+
WHITE = _table(b" \t\n\x0b\x0c\r")
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing A-Z)
ALNUM = _table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """Words of the texts of one slice: ``data[start:end]``; text t has words ``first[t]:first[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text starts (one more entry than texts). Null is empty."""
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches where ``column`` reaches ``limit`` bytes; one row at least.

    At the end free memory goes back to the system: a Python worker waits for its next task long after.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = bytes_of(batch.column(batch.schema.get_field_index(column)))
        row = 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
            yield batch.slice(row, to - row)
            row = to
    give_back()


def give_back() -> None:
    """Return memory that Arrow and the C library keep for later."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)


def find_words(column: pa.Array, kind: np.ndarray = WHITE, lower: bool = True) -> Words:
    data, offsets = bytes_of(column)
    if lower:
        data = LOWER[data]
    return words_in(data, offsets, kind)


def words_in(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    """Runs of bytes that ``kind`` allows; no run crosses from one text to the next."""
    inside = kind[data]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    opens, closes = inside.copy(), inside.copy()
    if len(data):
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), offsets)


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base % (1 << 64), pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                for name, base in (("up", self.base), ("down", self.inverse)):
                    steps = np.full(n, base, U)
                    steps[0] = 1
                    setattr(self, name, np.cumprod(steps))
        return self.up, self.down


_POWERS: dict[int, _Powers] = {}


def _powers(seed: int) -> _Powers:
    """One growing table for each seed and worker."""
    if seed not in _POWERS:
        _POWERS[seed] = _Powers(0x9E3779B97F4A7C15 + 2 * (seed * 0x51ED27 % (1 << 60)) | 1)
    return _POWERS[seed]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
        return x ^ (x >> U(33))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands.

    Powers cover one block of words, not the whole text, so memory follows the block.
    """
    out = np.empty(len(words.start), U)
    powers = _powers(seed)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(out):
            base = words.start[at]
            to = max(at + 1, int(np.searchsorted(words.end, base + HASH_BYTES, "right")))
            begin, end = words.start[at:to] - base, words.end[at:to] - base
            n = int(end[-1])
            up, down = powers.upto(n + 1)
            total = np.empty(n + 1, U)
            total[0] = 0
            np.cumsum((words.data[base : base + n].astype(U) + U(1)) * up[:n], out=total[1:])
            value = (total[end] - total[begin]) * down[begin]
            out[at:to] = mix(value ^ ((end - begin).astype(U) * U(0xD6E8FEB86659FD93)))
            at = to
    return out


def chain(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive entries; entry i stands for i .. i+size-1."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out = hashes[:n].copy()
    with np.errstate(over="ignore"):
        for k in range(1, size):
            out = mix(out * U(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return out


def runs(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``size`` words that stay in one text: their first words, and the text of each."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][owner] + within, owner


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of many ranges, one after another, and their offsets."""
    length = end - start
    offsets = np.concatenate([[0], np.cumsum(length)])
    index = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    return data[index], offsets


def distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each distinct word, in order of the first; a place where it stands; and for each word which of them it is."""
    one, index, inverse = np.unique(word_hashes(words), return_index=True, return_inverse=True)
    data, offsets = gather(words.data, words.start[index], words.end[index])
    return one, word_hashes(Words(data, offsets[:-1], offsets[1:], np.array([0, len(one)]), offsets), seed=1), index, inverse
