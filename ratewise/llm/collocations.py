"""Phrase collocations: frequent word sequences and how much they exceed chance.

The texts are read once, into blocks that hold their distinct words and, for each
position, the number of its word; what depends on a word alone is worked out once for each. Phrases then grow level by level. A phrase is a
candidate only if both its parts without the last and without the first word are
frequent, and if an upper bound of its own count reaches the minimum: the hashes of such
phrases, cut to a few more bits than there are words, are summed over all blocks, and
phrases that share a hash only add up. No frequent phrase is lost by that.

The candidates of a level, split by hash into shards of a bounded size, become
double-array tries: a state's children lie at its base plus their symbol, and hold the
state as their parent. One pass over the blocks sends each shard the sequences that may be
its candidates, each with how often a task met it. The task that has a shard builds its trie
and lets the states of many sequences advance at once, symbol by symbol, by numpy; what
the accepting states add up are exact counts. So a level's work grows with the blocks, not
with the blocks times the shards.

A symbol is the 64-bit hash of a word or, first, of the label that phrases are kept
apart by. Scores are integers of up to 38 digits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.text import WordHash, finish, groups_of, text_bytes
from ratewise.session import scratch_path

_HASH = WordHash(1201)
#: Candidates of one trie; with all its arrays that is below 20 MB.
SHARD = 1 << 18
#: Bits of the largest map that keeps infrequent parts away (32 MB). It is sized by what
#: it holds; beyond this it lets more pass, which costs rows, never a phrase.
SIEVE_BITS = 1 << 28
#: Positions whose sums meet in one task at most.
SUMMED = 1 << 20
#: Sequences that a task holds before it sends them to their shards.
SENT = 1 << 19
#: Keys of candidates that tasks are told not to give again, at most (8 MB).
KNOWN = 1 << 20
#: One in so many blocks gives its candidates before the others.
_WAVES = 8
_BLOCK_BYTES = 1 << 20
#: Blocks of a file; Spark reads all of a file's that fit a batch at once.
_FILE_BLOCKS = 32
_SLICE = 1 << 16
_WINDOW = 256

_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_INSIDE = ~_BREAKS
_INSIDE[list(b" \t")] = False


@dataclass
class Block:
    """The words of several labelled texts: positions refer to distinct labelled words."""

    labels: list[str]
    label: np.ndarray  # of each distinct labelled word: which label
    word: pa.Array | None  # and its text, where that is of use
    label_hash: np.ndarray
    word_hash: np.ndarray
    code: np.ndarray  # by position: which of them
    piece: np.ndarray  # by position: number of the piece of text

    def starts(self, n: int) -> np.ndarray:
        """Positions from which n words of one piece follow."""
        last = max(len(self.piece) - n + 1, 0)
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1 :][:last])

    def keys(self, at: np.ndarray, n: int) -> np.ndarray:
        """Hash of label and the n words from some positions on, across pieces too."""
        return self._keys([self.code[at + k] for k in range(n)])

    def word_keys(self) -> np.ndarray:
        """By distinct labelled word: what ``keys`` gives where it is."""
        return self._keys([np.arange(len(self.word_hash))])

    def _keys(self, words: list[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(words[0]), np.uint64)
        for code, p in zip(words, _HASH.power(len(words)), strict=True):
            total += self.word_hash[code] * p
        return finish(finish(total) ^ self.label_hash[words[0]])

    def phrases(self, at: np.ndarray, n: int) -> list[pa.Array]:
        """Labels and words, parted by blanks, of the phrases from some positions on."""
        words = [self.word.take(pa.array(self.code[at + k])) for k in range(n)]
        joined = pc.binary_join_element_wise(*words, " ") if n > 1 else words[0]
        label = pa.array(self.labels, pa.string()).take(pa.array(self.label[self.code[at]]))
        return [label, joined]


def first_places(code: np.ndarray) -> np.ndarray:
    """Where each of the numbers from 0 on, none left out, is first."""
    place = np.empty(int(code.max()) + 1 if len(code) else 0, np.int64)
    place[code[::-1]] = np.arange(len(code))[::-1]
    return place


def label_hashes(labels: list[str]) -> np.ndarray:
    """Hash of each label; it ends in a byte that no word has."""

    def of(label: str) -> np.uint64:
        data = np.frombuffer(label.encode() + b"\n", np.uint8)
        at = np.arange(len(data), dtype=np.int32)
        return _HASH.of(data, at, np.array([0]), np.array([len(data)]))[0]

    known = {label: of(label) for label in set(labels)}
    return np.array([known[x] for x in labels], np.uint64)


def block_of_texts(texts: list[bytes], labels: list[str]) -> Block:
    """The lower-cased words of the texts."""
    whole = np.frombuffer(b"\n".join(t.lower() for t in texts), np.uint8)
    breaks = _BREAKS[whole]
    inside = np.zeros(len(whole) + 2, bool)
    inside[1:-1] = _INSIDE[whole]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, length = edges[::2], edges[1::2] - edges[::2]
    first = np.cumsum(length) - length
    data = whole[inside[1:-1]]
    at = np.arange(len(data), dtype=np.int32) - np.repeat(first.astype(np.int32), length)
    hashes = _HASH.of(data, at, first, length)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    every, of_text = np.unique(np.array(labels, object), return_inverse=True)
    label = np.repeat(of_text, np.diff(np.searchsorted(starts, bounds))).astype(np.int32)
    label_hash = label_hashes(every.tolist())
    code = pa.array(hashes ^ label_hash[label]).dictionary_encode().indices.to_numpy()
    place = first_places(code)
    offsets = np.append(first, len(data)).astype(np.int32)
    words = pa.BinaryArray.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    return Block(
        every.tolist(),
        label[place],
        words.take(pa.array(place)).cast(pa.string()),
        label_hash[label[place]],
        hashes[place],
        code,
        np.cumsum(breaks, dtype=np.int32)[starts],
    )


def _small(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, each in as few bytes as the largest needs: first, how many these are,
    then the lowest byte of all numbers, the next of all, and so on, which compresses well."""
    width = max((int(numbers.max()).bit_length() + 7) // 8, 1) if len(numbers) else 1
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + planes.tobytes()


def _numbers(value: pa.Scalar) -> np.ndarray:
    """The numbers of ``_small``, as 64 bits."""
    data = np.frombuffer(value.as_buffer(), np.uint8)
    planes = data[1:].reshape(int(data[0]), -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, : len(planes)] = planes.T
    return whole.view("<i8").ravel()


#: A block as a row; all but the labels are the bytes of arrays, of the words those of
#: their texts, one after the other, and how many bytes each has.
_BLOCKS = (
    "labels array<string>, label_n array<bigint>, word binary, word_n binary, "
    "label binary, hash binary, code binary, fresh binary"
)


def _text_blocks(texts: DataFrame) -> DataFrame:
    """Blocks of about a megabyte of ``texts`` (label, text): labels with their numbers of
    words; of each distinct labelled word its text, label and hash; by position the number
    of its word, and a bit that says whether a new piece begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, labels = text_bytes(batch.column("text")), batch.column("label").to_pylist()
            for a, b in groups_of(found, _BLOCK_BYTES):
                block = block_of_texts(found[a:b], labels[a:b])
                n = np.bincount(block.label[block.code], minlength=len(block.labels))
                fresh = np.packbits(np.diff(block.piece, prepend=-1) != 0)
                _, bounds, words = block.word.buffers()
                bounds = np.frombuffer(bounds or bytes(4), np.int32)[: len(block.word) + 1]
                row = [[block.labels], [n.tolist()], [words.to_pybytes() if words else b""]]
                row += [[_small(np.diff(bounds))], [_small(block.label)], [block.word_hash.tobytes()]]
                row += [[_small(block.code)], [fresh.tobytes()]]
                names = ["labels", "label_n", "word", "word_n", "label", "hash", "code", "fresh"]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], names)

    return texts.mapInArrow(run, _BLOCKS)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks of rows; without a column of words these are left out."""

    def array(value: pa.Scalar, kind: type) -> np.ndarray:
        return np.frombuffer(value.as_buffer(), kind)

    for batch in batches:
        with_words = "word" in batch.schema.names
        for i in range(batch.num_rows):
            label, code = (_numbers(batch.column(c)[i]).astype(np.int32) for c in ("label", "code"))
            if not len(code):
                continue
            labels = batch.column("labels")[i].as_py()
            piece = np.unpackbits(array(batch.column("fresh")[i], np.uint8), count=len(code))
            words = None
            if with_words:
                bounds = np.append(np.int32(0), np.cumsum(_numbers(batch.column("word_n")[i]), dtype=np.int32))
                text = batch.column("word")[i].as_buffer()
                words = pa.StringArray.from_buffers(len(label), pa.py_buffer(bounds), text)
            yield Block(
                labels, label, words,
                label_hashes(labels)[label], array(batch.column("hash")[i], np.uint64),
                code, np.cumsum(piece, dtype=np.int32),
            )


# ---- sums ---------------------------------------------------------------------


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's numbers."""
    key, n = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.diff(key, prepend=key[:1] + np.uint64(1)))
    return key[first], np.add.reduceat(n, first) if len(first) else n


def summed(
    blocks: DataFrame,
    of_block: Callable[[Block], tuple[np.ndarray, np.ndarray]],
    bits: int,
    positions: int,
    least: int,
) -> DataFrame:
    """(key, n): sums from ``least`` on of what ``of_block`` gives, keys below 2 ** ``bits``.

    A task adds up its own blocks and sends ranges of keys, as steps from one to the next, of which there are so many
    that one gets ``SUMMED`` of the ``positions`` on average; keys must be spread evenly.
    """
    ranges = min(max(positions // SUMMED, 1).bit_length(), bits)
    below = np.uint64(max(bits - ranges, 0))

    def parts(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        key, n = _merged(found)
        bounds = np.searchsorted(key, np.arange(1 << ranges, dtype=np.uint64) << below)
        for i, (a, b) in enumerate(zip(bounds, [*bounds[1:], len(key)], strict=True)):
            if a < b:
                steps = np.diff(key[a:b], prepend=np.uint64(i) << below)
                row = [pa.array([i], pa.int32()), pa.array([_small(steps)], pa.binary())]
                row.append(pa.array([_small(n[a:b])], pa.binary()))
                yield pa.RecordBatch.from_arrays(row, ["range", "keys", "ns"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for block in _read(batches):
            held.append(of_block(block))
            size += len(held[-1][0])
            if size > SUMMED:
                held = [_merged(held)]
                size = len(held[0][0])
                if size > SUMMED // 2:
                    yield from parts(held)
                    held, size = [], 0
        if size:
            yield from parts(held)

    def add(table: pa.Table) -> pa.Table:
        base = np.uint64(table.column("range")[0].as_py()) << below
        rows = zip(table.column("keys"), table.column("ns"), strict=True)
        found = [(np.cumsum(_numbers(k).view(np.uint64)), _numbers(n)) for k, n in rows]
        key, n = _merged(found)
        enough = n >= least
        return pa.table({"key": pa.array((key[enough] + base).view(np.int64)), "n": pa.array(n[enough])})

    sent = blocks.mapInArrow(run, "range int, keys binary, ns binary")
    return sent.groupBy("range").applyInArrow(add, "key bigint, n bigint")


# ---- maps of frequent phrases -------------------------------------------------


class Sieve:
    """A bit map of 64-bit keys, two bits each: false for a key only if it isn't held."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.shift = np.uint64(64 - (len(bits) * 8).bit_length() + 1)

    @staticmethod
    def size(keys: int) -> int:
        """Bits for that many keys: 32 or more each, up to the bound."""
        return min(max(1 << (32 * keys).bit_length(), 1 << 16), SIEVE_BITS)

    def _places(self, keys: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
        at = finish(keys + np.uint64(which)) >> self.shift
        bit = np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)
        return (at >> np.uint64(3)).astype(np.int64), bit

    def add(self, keys: np.ndarray) -> None:
        for which in (0, 1):
            np.bitwise_or.at(self.bits, *self._places(keys, which))

    def has(self, keys: np.ndarray) -> np.ndarray:
        byte, bit = self._places(keys, 0)
        found = (self.bits[byte] & bit) != 0
        likely = np.flatnonzero(found)  # only these need the second bit
        byte, bit = self._places(keys[likely], 1)
        found[likely] = (self.bits[byte] & bit) != 0
        return found


def sieve_of(keys: DataFrame) -> Broadcast:
    """The map of the keys (key): tasks fill maps, whose slices are united by Spark.

    The driver gets one map of at most ``SIEVE_BITS``.
    """
    bits = Sieve.size(keys.count())
    width = min(bits // 8, _SLICE)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sieve(np.zeros(bits // 8, np.uint8))
        for batch in batches:
            own.add(batch.column("key").to_numpy().view(np.uint64))
        slices = own.bits.reshape(-1, width)
        held = np.flatnonzero(slices.any(axis=1))
        if len(held):
            data = pa.array([slices[i].tobytes() for i in held], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), data], ["slice", "bits"])

    def unite(table: pa.Table) -> pa.Table:
        whole = np.zeros(width, np.uint8)
        for part in table.column("bits"):
            whole |= np.frombuffer(part.as_buffer(), np.uint8)
        return pa.table({"slice": table.column("slice")[:1], "bits": pa.array([whole.tobytes()])})

    schema = "slice int, bits binary"
    filled = keys.select("key").mapInArrow(fill, schema)
    whole = np.zeros((bits // 8 // width, width), np.uint8)
    for row in filled.groupBy("slice").applyInArrow(unite, schema).collect():
        whole[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(Sieve(whole.reshape(-1)))


# ---- tries --------------------------------------------------------------------


@dataclass
class Trie:
    """A double-array trie over sequences of symbols of one length.

    A symbol is two digits, each a step, so that the children of a state lie close
    together and the arrays stay dense.
    """

    symbols: np.ndarray  # sorted
    code: np.ndarray  # number of each symbol, the most frequent first
    bits: int  # of a digit
    base: np.ndarray  # by state: what is added to a digit
    check: np.ndarray  # by state: the state it follows, -1 if there is none
    key: np.ndarray  # by state: which sequence ends there, -1 for none
    n: int

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """Numbers of symbols, -1 for those the trie doesn't have."""
        at = np.minimum(np.searchsorted(self.symbols, symbols), len(self.symbols) - 1)
        return np.where(self.symbols[at] == symbols, self.code[at], -1)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states after a symbol, -1 where there is none."""
        for digit in (code >> self.bits, code & ((1 << self.bits) - 1)):
            to = self.base[state] + digit
            to = np.where((to < 0) | (to >= len(self.check)), 0, to)  # the root follows none
            state = np.where((code >= 0) & (state >= 0) & (self.check[to] == state), to, -1)
        return state

    def counted(
        self, symbols: np.ndarray, sequences: list[np.ndarray], times: np.ndarray | None = None
    ) -> np.ndarray:
        """How often each sequence of the trie is among ``sequences``, which have a place
        among ``symbols`` for each step; ``times`` says how often each of them counts."""
        code = self.codes(symbols)
        state, alive = np.zeros(len(sequences[0]), np.int32), np.arange(len(sequences[0]))
        for place in sequences:
            state = self.step(state, code[place[alive]])
            alive, state = alive[state >= 0], state[state >= 0]
        # Sums below 2 ** 53 are exact in the floats that add them up.
        found = np.bincount(self.key[state], None if times is None else times[alive], self.n)
        return found.astype(np.int64)

    def accepted(self, block: Block, words: int) -> np.ndarray:
        """How often each sequence of a label and ``words`` words occurs in a block."""
        at = block.starts(words)
        symbols = np.concatenate([label_hashes(block.labels), block.word_hash])
        sequences = [block.label[block.code[at]]]
        sequences += [len(block.labels) + block.code[at + k] for k in range(words)]
        return self.counted(symbols, sequences)


class _Slots:
    """The free places of a double array, which grows as needed."""

    def __init__(self, size: int):
        self.free = np.ones(size, bool)
        self.free[0] = False  # the root

    def place(self, digits: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Places of the children of each state, most children first: the first free ones
        that their digits fit. Windows without a fit aren't tried again for as many."""
        cursor, fewest = 1, None
        for d in digits:
            if fewest is None or len(d) * 2 <= fewest:
                cursor, fewest = 1, len(d)
            offset = d - d[0]
            while True:
                while cursor + _WINDOW + offset[-1] >= len(self.free):
                    self.free = np.append(self.free, np.ones(len(self.free), bool))
                near = cursor + np.flatnonzero(self.free[cursor : cursor + _WINDOW])
                fits = self.free[near[:, None] + offset].all(axis=1)
                if fits.any():
                    own = near[fits.argmax()] + offset
                    break
                cursor += _WINDOW
            self.free[own] = False
            yield own

    def any(self, n: int) -> np.ndarray:
        """n free places."""
        while self.free.sum() < n:
            self.free = np.append(self.free, np.ones(len(self.free), bool))
        own = np.flatnonzero(self.free)[:n]
        self.free[own] = False
        return own


def build_trie(rows: np.ndarray) -> Trie:
    """The trie of distinct sequences, a row each, numbered as the rows are."""
    symbols, of, times = np.unique(rows, return_inverse=True, return_counts=True)
    code = np.empty(len(symbols), np.int32)
    code[np.argsort(-times, kind="stable")] = np.arange(len(symbols))
    bits = (len(symbols).bit_length() + 1) // 2
    codes = code[of.reshape(rows.shape)]
    digits = np.stack([codes >> bits, codes & ((1 << bits) - 1)], axis=2).reshape(len(rows), -1)
    order = np.lexsort(digits.T[::-1])
    digits = digits[order]
    # The states of a level are the distinct beginnings; children of one are adjacent.
    fresh = np.ones(digits.shape, bool)
    fresh[1:] = np.logical_or.accumulate(digits[1:] != digits[:-1], axis=1)
    number = np.cumsum(fresh, axis=0) - 1
    slots = _Slots(2 * int(fresh.sum()) + (2 << bits))
    levels, states = [], np.zeros(1, np.int64)
    for level in range(digits.shape[1]):
        child = np.flatnonzero(fresh[:, level])
        digit = digits[child, level]
        parent = number[child, level - 1] if level else np.zeros(len(child), np.int64)
        begin = np.flatnonzero(np.diff(parent, prepend=-1))
        count = np.diff(np.append(begin, len(child)))
        own = np.empty(len(child), np.int64)
        several = np.flatnonzero(count > 1)
        several = several[np.argsort(-count[several], kind="stable")]
        spans = [slice(a, a + n) for a, n in zip(begin[several].tolist(), count[several].tolist(), strict=True)]
        for span, place in zip(spans, slots.place([digit[x] for x in spans]), strict=True):
            own[span] = place
        single = begin[count == 1]
        own[single] = slots.any(len(single))  # one child fits anywhere
        levels.append((states[parent], own, digit))
        states = own
    used = int(np.flatnonzero(~slots.free)[-1]) + 1
    base, check = np.zeros(used, np.int32), np.full(used, -1, np.int32)
    for state, own, digit in levels:
        check[own] = state
        base[state] = own - digit
    key = np.full(used, -1, np.int32)
    key[states] = order
    return Trie(symbols, code.astype(np.int32), bits, base, check, key, len(rows))


# ---- levels -------------------------------------------------------------------


def _phrase_keys(phrases: DataFrame, words: int) -> DataFrame:
    """(key) of phrases (label, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column("phrase"))
            block = block_of_texts(texts, batch.column("label").to_pylist())
            key = block.keys(block.starts(words), words)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])

    return phrases.select("label", "phrase").mapInArrow(run, "key bigint")


def _safe(block: Block, words: int, parts: Broadcast | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of phrases whose two longest parts may be frequent, and their keys. Of a
    single word that a label has, only the first."""
    if words == 1:
        return first_places(block.code), block.word_keys()
    at = block.starts(words)
    if parts is not None and words == 2:
        ok = parts.value.has(block.word_keys())[block.code]
        at = at[ok[at] & ok[at + 1]]
    elif parts is not None:
        for k in (0, 1):
            at = at[parts.value.has(block.keys(at + k, words - 1))]
    return at, block.keys(at, words)


def _upper_bounds(
    blocks: DataFrame, words: int, parts: Broadcast | None, bits: int, positions: int, least: int
) -> DataFrame:
    """(key, n): occurrences of the phrases whose keys begin with the same bits."""
    shift = np.uint64(64 - bits)

    def of_block(block: Block) -> tuple[np.ndarray, np.ndarray]:
        _, key = _safe(block, words, parts)
        if words == 1:
            order = np.argsort(key)
            return key[order] >> shift, np.bincount(block.code)[order]
        return np.unique(key >> shift, return_counts=True)

    return summed(blocks, of_block, bits, positions, least)


def _known(candidates: DataFrame, most: int) -> Broadcast:
    """Keys of candidates (key) in order, ``most`` of them at most."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("key").to_numpy().tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["keys"])

    few = candidates.select("key").distinct().limit(most).mapInArrow(pack, "keys binary")
    found = [np.frombuffer(row["keys"], np.uint64) for row in few.collect()]
    keys = np.sort(np.concatenate([np.empty(0, np.uint64), *found]))
    return candidates.sparkSession.sparkContext.broadcast(keys)


def _given(
    blocks: DataFrame, words: int, parts: Broadcast | None, held: Broadcast, bits: int,
    known: Broadcast | None = None,
) -> DataFrame:
    """(key, label, phrase) of phrases whose bounds are ``held``, but for the ``known``."""
    shift = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.empty(0, np.uint64)  # what the task has given already
        for block in _read(batches):
            at, key = _safe(block, words, parts)
            likely = held.value.has(key >> shift)
            key, first = np.unique(key[likely], return_index=True)
            new = ~np.isin(key, met, assume_unique=True)
            if known is not None and len(known.value):
                place = np.minimum(np.searchsorted(known.value, key), len(known.value) - 1)
                new &= known.value[place] != key
            met = np.append(met if len(met) < SUMMED else met[:0], key[new])
            columns = [pa.array(key[new].view(np.int64))]
            columns += block.phrases(at[likely][first[new]], words)
            yield pa.RecordBatch.from_arrays(columns, ["key", "label", "phrase"])

    return blocks.mapInArrow(run, "key bigint, label string, phrase string")


def _candidates(
    blocks: DataFrame, words: int, parts: Broadcast | None, held: Broadcast, bits: int
) -> DataFrame:
    """(key, label, phrase): the phrases whose bounds are ``held``.

    Some of the blocks go first; tasks of the others leave out what these have given. That
    list is bounded, and what it doesn't hold is given again, which costs rows only.
    """
    early = F.pmod(F.xxhash64("fresh", "hash"), F.lit(_WAVES)) == 0
    first = _given(blocks.filter(early), words, parts, held, bits)
    first = _written(first, f"phrase-early-{words}")
    rest = _given(blocks.filter(~early), words, parts, held, bits, _known(first, KNOWN))
    return first.union(rest).distinct()


def _sequences(
    blocks: DataFrame, words: int, parts: Broadcast | None, held: Broadcast, bits: int, split: int
) -> DataFrame:
    """(shard, symbols, sequences, times): the phrases whose bounds are ``held``, as a task
    met them, by shard: the first ``split`` bits of their keys. ``symbols`` are the hashes of
    labels and words; the sequences are places among them, all labels first, then all first words."""
    shift, below = np.uint64(64 - bits), np.uint64(64 - split)

    def of_block(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, key = _safe(block, words, parts)
        likely = held.value.has(key >> shift)
        at, key = at[likely], key[likely]
        which, kinds = pd.factorize(key)
        place = first_places(which)
        n = np.bincount(which)
        if words == 1:  # of a word only its first position is there
            n = np.bincount(block.code)[block.code[at[place]]]
        at = at[place]
        symbols = [block.label_hash[block.code[at]]]
        symbols += [block.word_hash[block.code[at + k]] for k in range(words)]
        return kinds, n, np.stack(symbols)

    def merged(found: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, n = (np.concatenate(x) for x in list(zip(*found, strict=True))[:2])
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=key[:1] + np.uint64(1)))
        total = np.add.reduceat(n[order], first) if len(first) else n
        return key[first], total, np.concatenate([x[2] for x in found], axis=1)[:, order[first]]

    def given(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, n, symbols = merged(found)
        shard = (key >> below).astype(np.int64) if split else np.zeros(len(key), np.int64)
        begin = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(begin, [*begin[1:], len(key)], strict=True):
            place, known = pd.factorize(symbols[:, a:b].ravel())
            place = place.reshape(words + 1, -1)
            order = np.lexsort(place[::-1])  # equal beginnings next to each other take less room
            data = [known.tobytes(), _small(place[:, order].ravel()), _small(n[a:b][order])]
            row = [pa.array([shard[a]], pa.int32()), *(pa.array([x], pa.binary()) for x in data)]
            yield pa.RecordBatch.from_arrays(row, ["shard", "symbols", "sequences", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for block in _read(batches):
            found.append(of_block(block))
            size += len(found[-1][0])
            if size > SENT:
                found = [merged(found)]
                size = len(found[0][0])
                if size > SENT // 2:
                    yield from given(found)
                    found, size = [], 0
        if size:
            yield from given(found)

    return blocks.mapInArrow(run, "shard int, symbols binary, sequences binary, times binary")


def _trie_of(label: pa.ChunkedArray, phrase: pa.ChunkedArray, words: int) -> Trie:
    """The trie of phrases; a sequence's number in it is its place among them."""
    rows = np.empty((len(phrase), words + 1), np.uint64)
    for a in range(0, len(phrase), _SLICE):
        texts, labels = text_bytes(phrase.slice(a, _SLICE)), label.slice(a, _SLICE).to_pylist()
        block = block_of_texts(texts, labels)
        code = block.code[block.starts(words)[:, None] + np.arange(words)]
        rows[a : a + _SLICE, 0] = block.label_hash[code[:, 0]]
        rows[a : a + _SLICE, 1:] = block.word_hash[code]
    return build_trie(rows)


def _exact_counts(
    candidates: DataFrame, sequences: DataFrame, words: int, split: int, least: int
) -> DataFrame:
    """(label, phrase, n): how often the candidates (key, label, phrase) are among the
    sequences, those from ``least`` on. A task has one shard's trie at a time."""
    shard = F.shiftrightunsigned("key", 64 - split) if split else F.lit(0)
    names = candidates.select(
        shard.cast("int").alias("shard"), "label", "phrase",
        *(F.lit(None).cast("binary").alias(c) for c in ("symbols", "sequences", "times")),
    )
    met = sequences.select(
        "shard", *(F.lit(None).cast("string").alias(c) for c in ("label", "phrase")),
        "symbols", "sequences", "times",
    )
    both = names.unionByName(met).withColumn("met", F.col("symbols").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trie, total = None, None, None
        pieces: list[pa.RecordBatch] = []

        def given() -> Iterator[pa.RecordBatch]:
            if trie is not None:
                enough = np.flatnonzero(total >= least)
                columns = [x.take(pa.array(enough)).combine_chunks() for x in pa.Table.from_batches(pieces).columns]
                columns.append(pa.array(total[enough], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, ["label", "phrase", "n"])

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            is_met = batch.column("met").to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(np.diff(shards * 2 + is_met, prepend=-1))
            for a, b in zip(begin.tolist(), [*begin.tolist()[1:], len(shards)], strict=True):
                if shards[a] != now:
                    yield from given()
                    now, trie, total, pieces = shards[a], None, None, []
                part = batch.slice(a, b - a)
                if not is_met[a]:
                    # Copied, or the whole batch would stay in memory.
                    names = part.select(["label", "phrase"])
                    pieces.append(names.take(pa.array(np.arange(b - a))))
                    continue
                if not pieces:  # no phrase of these is a candidate
                    continue
                if trie is None:
                    names = pa.Table.from_batches(pieces)
                    trie = _trie_of(names["label"], names["phrase"], words)
                    total = np.zeros(trie.n, np.int64)
                for i in range(b - a):
                    symbols = np.frombuffer(part.column("symbols")[i].as_buffer(), np.uint64)
                    place, times = (_numbers(part.column(c)[i]) for c in ("sequences", "times"))
                    total += trie.counted(symbols, list(place.reshape(words + 1, -1)), times)
        yield from given()

    by_shard = both.repartition("shard").sortWithinPartitions("shard", "met")
    return by_shard.mapInArrow(run, "label string, phrase string, n bigint")


def _written(df: DataFrame, name: str, rows: int = 0) -> DataFrame:
    """``df`` read from files, of at most so many rows if that is given."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.parquet(path)


def frequent_phrases(
    texts: DataFrame, min_count: int = 10, max_words: int = 3, shard: int = SHARD
) -> tuple[DataFrame, DataFrame]:
    """((label, n), (label, phrase, size, n)): all words of each label, and all phrases of
    one to ``max_words`` words that occur ``min_count`` times or more, of ``texts`` (label, text).

    Phrases lie within a piece of text and may overlap. The texts are read once; each
    level goes through their blocks three times, however many shards its candidates fill.
    """
    named = _written(_text_blocks(texts), "phrase-blocks", _FILE_BLOCKS)
    blocks = named.select("labels", "label", "hash", "code", "fresh")
    of_label = named.select(F.explode(F.arrays_zip("labels", "label_n")).alias("x"))
    totals = of_label.groupBy(F.col("x.labels").alias("label")).agg(F.sum("x.label_n").alias("n"))
    named = named.drop("label_n")
    positions = int(totals.agg(F.sum("n")).first()[0] or 0)
    bits = min(max(positions.bit_length() + 7, 16), 62)  # one in a hundred shares a bound
    found, level = None, None
    for n in range(1, max_words + 1):
        parts = sieve_of(_phrase_keys(level, n - 1)) if n > 1 else None
        bounds = _upper_bounds(blocks, n, parts, bits, positions, min_count)
        bounds = _written(bounds, f"phrase-bounds-{n}")
        held = sieve_of(bounds)
        wanted = _written(_candidates(named, n, parts, held, bits), f"phrase-candidates-{n}")
        candidates = wanted.count()
        if not candidates:
            break
        split = (max(math.ceil(candidates / shard), 1) - 1).bit_length()
        sequences = _sequences(blocks, n, parts, held, bits, split)
        level = _exact_counts(wanted, sequences, n, split, min_count)
        level = _written(level.select("label", "phrase", F.lit(n).alias("size"), "n"), f"phrases-{n}")
        for shared in (parts, held):
            if shared is not None:
                shared.unpersist()
        found = level if found is None else found.unionByName(level)
    if found is None:
        found = texts.sparkSession.createDataFrame([], "label string, phrase string, size int, n bigint")
    return totals, found


def _parts(first: int | F.Column, size: int | F.Column) -> F.Column:
    """Words of a phrase, from the first-th on."""
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """(label, phrase, size, a, l, r, score) of the phrases of several words.

    A phrase is cut where that scores least, the first such place: ``l`` and ``r`` are
    the counts of its two parts, the score is floor(1,000,000 * a * a / (l * r)).
    """
    cuts = phrases.filter("size > 1").select(
        "label", "phrase", "size", F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"),
    )
    cuts = cuts.withColumns(
        {"left": _parts(1, F.col("cut")), "right": _parts(F.col("cut") + 1, F.col("size") - F.col("cut"))}
    )
    left = phrases.select("label", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = phrases.select("label", F.col("phrase").alias("right"), F.col("n").alias("r"))
    wide = "cast({} as decimal(19, 0))"
    product = f"cast(1000000 as decimal(7, 0)) * ({wide.format('a')} * {wide.format('a')})"
    score = F.expr(f"cast({product} as decimal(38, 0)) div ({wide.format('l')} * {wide.format('r')})")
    best = (
        cuts.join(left, ["label", "left"])
        .join(right, ["label", "right"])
        .select("label", "phrase", "size", "a", F.struct(score.alias("score"), "cut", "l", "r").alias("x"))
        .groupBy("label", "phrase", "size", "a")
        .agg(F.min("x").alias("x"))
    )
    return best.select("label", "phrase", "size", "a", "x.l", "x.r", "x.score")


def without_parts(candidates: DataFrame, percent: int = 50) -> DataFrame:
    """Candidates (label, phrase, size, a) but those inside a longer one that has ``percent``
    per cent or more of their count."""
    inner = candidates.filter("size > 2").select(
        "label", "phrase", "size", "a",
        F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("n"),
    )
    inner = inner.select(
        "label", "phrase", "a", "n", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)).alias("i")
    ).select("label", "a", _parts(F.col("i"), F.col("n")).alias("phrase"))
    longest = inner.groupBy("label", "phrase").agg(F.max("a").alias("longest"))
    kept = F.col("longest").isNull() | (100 * F.col("longest") < percent * F.col("a"))
    return candidates.join(longest, ["label", "phrase"], "left").filter(kept).drop("longest")


def collocations(
    docs: DataFrame,
    label: str = "lang",
    text: str = "text",
    top: int = 2000,
    min_count: int = 10,
    max_words: int = 3,
    percent: int = 50,
    shard: int = SHARD,
) -> DataFrame:
    """(label, rank, phrase, size, a, l, r, n, score): the ``top`` phrases of each label by
    score, then count, then phrase; ``n`` counts all words of the label.

    Defined results: texts without a label are of the label ``und``; null and empty texts
    have no words; texts may be of any length; repeated rows count each; an empty table
    and labels without a frequent phrase give no rows; other columns aren't read.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{label}`").cast("string"), F.lit("und")).alias("label"),
        F.col(f"`{text}`").alias("text"),
    )
    totals, phrases = frequent_phrases(texts, min_count, max_words, shard)
    kept = without_parts(scored(phrases), percent)
    order = Window.partitionBy("label").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.filter(F.col("rank") <= top).join(totals, "label").select(
        "label", "rank", "phrase", "size", "a", "l", "r", "n", "score"
    )
