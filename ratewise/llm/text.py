"""Words, their hashes and document blocks, shared by the operators.

A word is a run of bytes other than blank and the control characters 09-0D, so
it can be found on the UTF-8 bytes; lower case means A-Z only. ``bytes.lower``
and ``bytes.split`` do exactly that.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[ \t\n\x0B\f\r]+"
#: Text bytes that one block of documents aims at.
BLOCK_BYTES = 16 << 20

_GAPS = np.zeros(256, bool)
_GAPS[[9, 10, 11, 12, 13, 32]] = True


def free_prefix(columns: list[str]) -> str:
    """Underscores that no column's name begins with, for columns of an operator's own."""
    prefix = "_"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    line = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    rare = r"[\t\x0B\f\r]"  # most texts have none; a split at one character needs no pattern
    plain = F.when(line.rlike(rare), F.regexp_replace(line, rare, " ")).otherwise(line)
    return F.array_remove(F.split(plain, " "), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    A column that a lambda refers to would be computed anew for each element
    once the optimizer has moved its expression there; a lambda's own variable
    never is.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


def block_count(docs: DataFrame, size: int = BLOCK_BYTES) -> int:
    """How many blocks of about ``size`` text bytes the documents fill."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(total // size) + 1


def block_of(columns: list[str], blocks: int) -> Column:
    """Block of a row, from its values only, so that a repeated task finds the same."""
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def finish(h: np.ndarray) -> np.ndarray:
    """Mix 64-bit values so that any of their bits can serve as a bucket."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


class WordHash:
    """64-bit hash of words: random values of the bytes times powers of an odd number."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.values = random.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = np.uint64(int(random.integers(2**40, 2**60)) * 8 + 3)
        self.powers = np.ones(1, np.uint64)

    def power(self, n: int) -> np.ndarray:
        """The first n powers of the base."""
        if len(self.powers) < n:
            grown = np.full(max(n, 2 * len(self.powers)), self.base, np.uint64)
            grown[0] = 1
            self.powers = np.multiply.accumulate(grown)
        return self.powers[:n]

    def of(self, data: np.ndarray, at: np.ndarray, first: np.ndarray, length: np.ndarray):
        """Hashes of the words that start at ``first`` within the word bytes ``data``."""
        if not len(first):
            return np.empty(0, np.uint64)
        weighted = self.values[data]
        weighted *= self.power(int(length.max()))[at]
        return finish(np.add.reduceat(weighted, first) + length.astype(np.uint64))

    def runs(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Hash of each run of n consecutive values."""
        if len(hashes) < n:
            return np.empty(0, np.uint64)
        total = np.zeros(len(hashes) - n + 1, np.uint64)
        for k, p in enumerate(self.power(n)):
            total += hashes[k : len(hashes) - n + 1 + k] * p
        return finish(total)


@dataclass
class Words:
    """Words of several texts, one after the other."""

    data: np.ndarray  # the bytes of all words
    at: np.ndarray  # place of each byte in its word
    first: np.ndarray  # where each word starts in data
    length: np.ndarray  # bytes of each word
    bounds: np.ndarray  # of text i: words bounds[i] to bounds[i + 1]

    def hashes(self, by: WordHash) -> np.ndarray:
        return by.of(self.data, self.at, self.first, self.length)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def split_words(texts: list[bytes]) -> Words:
    """All words of the texts by a few passes over their bytes."""
    whole = np.frombuffer(b"\n".join(texts), np.uint8)
    inside = ~_GAPS[whole]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = ends - starts
    first = np.cumsum(length) - length
    data = whole[inside]
    at = (np.arange(len(data)) - np.repeat(first, length)).astype(np.int32)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    return Words(data, at, first, length, bounds)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string or binary column, none for null."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def groups_of(texts: list[bytes], size: int = 1 << 20):
    """Ranges of texts that have about ``size`` bytes together."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
