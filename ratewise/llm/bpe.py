"""Byte-level BPE: encoding of texts into token ids and decoding of ids into texts.

A text is cut at the strings of special tokens and then into pieces: a contraction,
a run of letters, of numbers or of other marks with the blank before it, a run of
white space. The bytes of a piece are its first parts. Of all pairs of neighbouring
parts the one that the tokenizer learnt first is joined, the leftmost of several,
until no pair is left that it knows.

Short pieces of a batch are joined side by side, one row a piece, in contiguous
arrays: the boundaries of its parts and the rank of each boundary between two
parts. Each round scans every row for its least rank, deletes that boundary and
ranks the two beside it anew. That takes time with the square of the length, so
pieces above ``SHORT`` bytes keep their ranks in a heap instead. Each distinct piece
of a task is joined once while it stays in a bounded cache.

The tables of the tokenizer come from its file, which the driver reads; their size
is that of the vocabulary, so they are broadcast.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from ratewise.llm.text import WordHash, groups_of, text_bytes

#: Bytes of the longest piece that is joined by scanning.
SHORT = 32
#: Distinct pieces whose ids a task keeps.
CACHED = 1 << 18
#: Pieces that are joined side by side.
SIDE_BY_SIDE = 1 << 14

_HASH = WordHash(1301)
_NONE = np.int32(2**31 - 1)
_LETTER, _NUMBER, _SPACE, _OTHER, _BREAK = range(5)
# What is cut off after an apostrophe, by first and second letter.
_ONE_LETTER, _TWO_LETTERS = b"stmd", (b"re", b"ve", b"ll")


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in the file of a byte-level tokenizer.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in itself]
    return {chr(b): b for b in itself} | {chr(256 + i): b for i, b in enumerate(others)}


def character_classes() -> np.ndarray:
    """Class of each code point, by the Unicode tables of the tokenizers library."""
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    whole, at = "".join(map(chr, points)), np.array(points)
    classes = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        found = np.ones(len(points), bool)
        for _, (a, b) in Split(Regex(pattern), "removed").pre_tokenize_str(whole):
            found[a:b] = False
        classes[at[found]] = kind
    return classes


@dataclass(frozen=True)
class Vocabulary:
    """What a byte-level BPE tokenizer file holds, as arrays."""

    pairs: np.ndarray  # left id * 2 ** 32 + right id of every pair it joins, sorted
    ranks: np.ndarray  # the rank of each pair
    joined: np.ndarray  # by rank: the id of the joined part
    byte_ids: np.ndarray  # by byte: the id it begins with
    token_bytes: dict[int, bytes]  # by id
    specials: dict[bytes, int]  # ids of the strings that are never cut
    classes: np.ndarray  # by code point

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; ``_NONE`` where they are never joined."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], _NONE)


def read_vocabulary(path: str) -> Vocabulary:
    """The tables of a tokenizer file; refuses files whose steps aren't those of this module.

    Truncation, padding and post-processing of the file are left aside.
    """
    file = json.loads(Path(path).read_text(encoding="utf-8"))
    model, split = file["model"], file["pre_tokenizer"] or {}
    unused = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
    if (
        file["normalizer"] is not None
        or split.get("type") != "ByteLevel"
        or split.get("add_prefix_space")
        or not split.get("use_regex", True)
        or (file["decoder"] or {}).get("type") != "ByteLevel"
        or model.get("type", "BPE") != "BPE"
        or any(model.get(k) for k in (*unused, "byte_fallback", "ignore_merges", "fuse_unk"))
    ):
        raise ValueError(f"{path} isn't a plain byte-level BPE tokenizer")
    if any(t[k] for t in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path} has special tokens that take in what is beside them")
    ids, byte_of = model["vocab"], printable_bytes()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left = np.array([ids[a] for a, _ in merges], np.int64)
    pairs = (left << 32) | np.array([ids[b] for _, b in merges], np.int64)
    order = np.argsort(pairs, kind="stable")
    byte_ids = np.zeros(256, np.int32)
    for c, b in byte_of.items():
        byte_ids[b] = ids[c]
    specials = {t["content"]: t["id"] for t in file["added_tokens"]}
    named = {**ids, **specials}
    return Vocabulary(
        pairs=pairs[order],
        ranks=order.astype(np.int32),
        joined=np.array([ids[a + b] for a, b in merges], np.int32),
        byte_ids=byte_ids,
        token_bytes={
            i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
            for t, i in named.items()
        },
        specials={t.encode(): i for t, i in specials.items()},
        classes=character_classes(),
    )


# ---- pieces of texts ----------------------------------------------------------


def byte_classes(data: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte's character, and which bytes begin a character."""
    begins = (data & 0xC0) != 0x80
    kinds = classes[:128][data & 0x7F]
    if data.max(initial=0) < 0x80:
        return kinds, begins
    first = np.flatnonzero(begins & (data >= 0x80))
    lead = data[first].astype(np.int64)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & np.where(size == 2, 0x1F, np.where(size == 3, 0x0F, 0x07))
    for k in (1, 2, 3):
        more = size > k
        point[more] = (point[more] << 6) | (data[first[more] + k] & 0x3F)
    for k in range(4):
        more = size > k
        kinds[first[more] + k] = classes[point[more]]
    return kinds, begins


def pieces(texts: list[bytes], vocabulary: Vocabulary) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts as one string of bytes, and where each piece begins and ends in it.

    Between two texts stands a byte that belongs to no piece.
    """
    whole = b"\n".join(texts)
    data = np.frombuffer(whole, np.uint8)
    kinds, begins = byte_classes(data, vocabulary.classes)
    gaps = np.cumsum([len(t) + 1 for t in texts[:-1]], dtype=np.int64) - 1
    kinds[gaps] = _BREAK
    if not len(data):
        return whole, np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.flatnonzero(np.diff(kinds, prepend=255))  # of runs of one class
    end = np.append(start[1:], len(data))
    kind = kinds[start]
    after = np.append(kind[1:], _BREAK)
    blank = np.append(False, (data[start[1:] - 1] == 32) & (kind[:-1] == _SPACE))

    cuts = np.zeros(len(data) + 1, bool)
    solid = (kind != _SPACE) & (kind != _BREAK)
    cuts[(start - blank)[solid]] = True
    space = kind == _SPACE
    cuts[start[space & (after == _BREAK)]] = True
    # Of white space before something else the last character stands apart: a blank
    # goes to what follows, any other is a piece of its own.
    leading = space & (after != _BREAK)
    firsts = np.flatnonzero(begins)
    last = firsts[np.searchsorted(firsts, end[leading]) - 1]
    cuts[last] = True
    cuts[start[leading]] = True

    # A contraction: a lone apostrophe without a blank before it, and certain letters.
    padded = np.append(data, np.zeros(3, np.uint8))
    lone = (kind == _OTHER) & (end - start == 1) & (data[start] == 39) & ~blank
    lone &= after == _LETTER
    a, b = padded[end], padded[end + 1]
    letters = np.append(end[1:], len(data)) - end  # bytes of the run that follows
    taken = np.where(np.isin(a, list(_ONE_LETTER)), 1, 0)
    for x, y in _TWO_LETTERS:
        taken = np.where((a == x) & (b == y) & (letters > 1), 2, taken)
    short = lone & (taken > 0)
    cuts[end[short]] = False
    rest = short & (letters > taken)
    cuts[(end + taken)[rest]] = True

    begin = np.flatnonzero(cuts[:-1])
    if not len(begin):
        return whole, begin, begin
    stop = np.append(begin[1:], len(data))
    # A piece before a gap ends there.
    broken = np.flatnonzero(kinds == _BREAK)
    at = np.searchsorted(begin, broken) - 1
    has = at >= 0
    np.minimum.at(stop, at[has], broken[has])
    return whole, begin, stop


# ---- joining parts ------------------------------------------------------------


def join_short(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words' parts, one word after the other, and the number of each word's."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    n, width = len(words), int(length.max())
    place = np.arange(width)
    inside = place < length[:, None]
    token = np.zeros((n, width), np.int32)  # id of the part that begins at a byte
    token[inside] = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    # Row by row: where parts begin, the end of the word last, and for each part the
    # rank of joining it with the next.
    edge = np.broadcast_to(np.arange(width + 1), (n, width + 1)).copy()
    rank = np.full((n, width), _NONE, np.int32)
    known = place[:-1] < length[:, None] - 1
    rank[:, :-1][known] = vocabulary.rank_of(token[:, :-1][known], token[:, 1:][known])
    count = length.copy()
    live = np.arange(n)
    while len(live):
        at = rank[live].argmin(axis=1)
        least = rank[live, at]
        go = least < _NONE
        live, at, least = live[go], at[go], least[go]
        token[live, edge[live, at]] = vocabulary.joined[least]
        later = place >= at[:, None] + 1
        edge[live] = np.take_along_axis(
            edge[live], np.append(place + later, np.full((len(live), 1), width), axis=1), axis=1
        )
        moved = np.minimum(place + later, width - 1)
        rank[live] = np.take_along_axis(rank[live], moved, axis=1)
        rank[live, width - 1] = _NONE
        count[live] -= 1
        for side in (at - 1, at):
            real = (side >= 0) & (side < count[live] - 1)
            row, col = live[real], side[real]
            fresh = vocabulary.rank_of(token[row, edge[row, col]], token[row, edge[row, col + 1]])
            rank[row, col] = fresh
            row, col = live[~real & (side >= 0)], side[~real & (side >= 0)]
            rank[row, col] = _NONE
    parts = place < count[:, None]
    row, col = np.nonzero(parts)
    return token[row, edge[row, col]], count


def join_long(word: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """Ids of the parts of a word of any length: a heap of ranks over linked parts."""
    token = vocabulary.byte_ids[np.frombuffer(word, np.uint8)].copy()
    n = len(token)
    ranks = np.append(vocabulary.rank_of(token[:-1], token[1:]), _NONE)
    heap = [(int(r), i) for i, r in enumerate(ranks) if r != _NONE]
    heapq.heapify(heap)
    rank = ranks.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    known: dict[tuple[int, int], int] = {}

    def renew(i: int) -> None:
        j = after[i]
        rank[i] = int(_NONE)
        if j < n:
            pair = int(token[i]), int(token[j])
            if pair not in known:
                known[pair] = int(vocabulary.rank_of(*(np.array([x]) for x in pair))[0])
            rank[i] = known[pair]
            if rank[i] != _NONE:
                heapq.heappush(heap, (rank[i], i))

    gone = bytearray(n)
    while heap:
        r, i = heapq.heappop(heap)
        if gone[i] or rank[i] != r:
            continue
        j = after[i]
        token[i] = vocabulary.joined[r]
        gone[j] = 1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        renew(i)
        if before[i] >= 0:
            renew(before[i])
    return token[np.frombuffer(gone, np.uint8) == 0]


def take(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices of ``values`` that begin at ``first``, one after the other."""
    before = np.cumsum(size) - size
    return values[np.repeat(first - before, size) + np.arange(int(size.sum()))]


def distinct(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words, slices of ``data``, are the first of their kind, and the kind of each.

    Words are told apart by their 64-bit hashes, which are checked against their bytes.
    """
    before = np.cumsum(size) - size
    held = take(data, first, size)
    place = (np.arange(len(held)) - np.repeat(before, size)).astype(np.int32)
    _, one, kind = np.unique(_HASH.of(held, place, before, size), return_index=True, return_inverse=True)
    same = first[one][kind]
    if (size[one][kind] == size).all() and (take(data, same, size) == held).all():
        return one, kind
    words = [data[a : a + n].tobytes() for a, n in zip(first.tolist(), size.tolist(), strict=True)]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    kind = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return np.unique(kind, return_index=True)[1], kind


class Memo:
    """Ids of words, found once while they stay in a store of a bounded size."""

    def __init__(
        self, find: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int = CACHED
    ):
        self.find, self.limit = find, limit
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.known = np.empty(0, np.int32)
        self.bounds = np.zeros(1, np.int64)

    def ids(
        self, whole: bytes, first: np.ndarray, size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, slices of ``whole``, and where those of each word begin."""
        one, kind = distinct(np.frombuffer(whole, np.uint8), first, size)
        ends = (first + size)[one].tolist()
        words = [whole[a:b] for a, b in zip(first[one].tolist(), ends, strict=True)]
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > self.limit:
            self._forget()
            new = words
        if new:
            new = sorted(new, key=len)
            ids, count = self.find(new)
            known = len(self.number)
            self.number.update(zip(new, range(known, known + len(new)), strict=True))
            self.known = np.append(self.known, ids)
            self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(count))
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))[kind]
        count = (self.bounds[1:] - self.bounds[:-1])[number]
        return take(self.known, self.bounds[number], count), np.append(0, np.cumsum(count))


def join_parts(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the parts of words in the order of their lengths, and each one's number."""
    short = sum(len(w) <= SHORT for w in words)
    found = [
        join_short(words[a : min(a + SIDE_BY_SIDE, short)], vocabulary)
        for a in range(0, short, SIDE_BY_SIDE)
    ]
    for word in words[short:]:
        ids = join_long(word, vocabulary)
        found.append((ids, np.array([len(ids)])))
    ids, count = zip(*found, strict=True)
    return np.concatenate(ids), np.concatenate(count)


class Encoder:
    """Encodes texts; remembers the ids of pieces."""

    def __init__(self, vocabulary: Vocabulary, specials: bool = True, cached: int = CACHED):
        self.vocabulary = vocabulary
        strings = sorted(vocabulary.specials, key=lambda s: (-len(s), s)) if specials else []
        self.special = re.compile(b"(" + b"|".join(map(re.escape, strings)) + b")") if strings else None
        self.memo = Memo(lambda words: join_parts(words, vocabulary), cached)

    def _encode_plain(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens, one after the other, and their bounds."""
        whole, begin, stop = pieces(texts, self.vocabulary)
        ids, total = self.memo.ids(whole, begin, stop - begin)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        return ids, total[np.searchsorted(begin, starts)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other, and where each text's begin and end."""
        if self.special is None or not any(map(self.special.search, texts)):
            return self._encode_plain(texts)
        parts = [self.special.split(t) for t in texts]  # every other one is special
        ids, bounds = self._encode_plain([p for x in parts for p in x[::2]])
        found, sizes, k = [], [], 0
        for x in parts:
            size = 0
            for i, p in enumerate(x):
                if i % 2:
                    own = np.array([self.vocabulary.specials[p]], np.int32)
                else:
                    own = ids[bounds[k] : bounds[k + 1]]
                    k += 1
                found.append(own)
                size += len(own)
            sizes.append(size)
        return np.concatenate(found), np.append(0, np.cumsum(sizes))


class Decoder:
    """Bytes of token ids; ids that it doesn't have give none."""

    def __init__(self, token_bytes: dict[int, bytes]):
        top = max(token_bytes, default=-1) + 1
        by_id = [token_bytes.get(i, b"") for i in range(top)]
        self.data = np.frombuffer(b"".join(by_id), np.uint8)
        self.bounds = np.append(0, np.cumsum([len(b) for b in by_id], dtype=np.int64))

    def spans(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, and where each id's begin and end."""
        ids = np.asarray(ids, np.int64)
        real = (ids >= 0) & (ids < len(self.bounds) - 1)
        own = np.where(real, ids, 0)
        size = np.where(real, self.bounds[own + 1] - self.bounds[own], 0)
        return take(self.data, self.bounds[own], size).tobytes(), np.append(0, np.cumsum(size))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Texts in UTF-8; bytes that aren't UTF-8 become U+FFFD."""
        whole, total = self.spans(ids)
        at = total[bounds].tolist()
        return [_valid(whole[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _valid(text: bytes) -> bytes:
    return text if text.isascii() else text.decode("utf-8", "replace").encode()


# ---- DataFrames ---------------------------------------------------------------


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    """The frame without columns of that name, and its schema with a new one at the end."""
    others = [c for c in df.columns if c.lower() != name.lower()]
    if len(others) < len(df.columns):
        df = df.withColumnsRenamed({c: f"{c} before" for c in df.columns if c not in others})
    return df, T.StructType([f for f in df.schema if f.name in others] + [T.StructField(name, kind)])


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with about a megabyte of text, and their texts."""
    texts = [_valid(t) for t in text_bytes(batch.column(column))]
    for a, b in groups_of(texts):
        yield batch.slice(a, b - a), texts[a:b]


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    to: str = "ids",
    specials: bool = True,
) -> DataFrame:
    """The rows of ``docs`` with the token ids of their text as ``to`` (array of int).

    The strings of special tokens are these tokens, or plain text with
    ``specials=False``; no tokens are added. A column that is called ``to`` in any
    case gives way. Defined results: null and empty texts have no ids; bytes that are
    no UTF-8 count as U+FFFD; texts and pieces may be of any length; repeated rows each get their row; an empty table
    gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    source, schema = _with_column(docs, to, T.ArrayType(T.IntegerType()))
    kept = schema.names[:-1]
    read = text if text in source.columns else f"{text} before"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, specials)
        for batch in batches:
            for part, texts in _slices(batch, read):
                ids, bounds = encoder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, lists], [*kept, to])

    return source.mapInArrow(run, schema)


def decode(
    tokens: DataFrame, vocabulary: Vocabulary, ids: str = "ids", to: str = "text"
) -> DataFrame:
    """The rows of ``tokens`` with the text of their ids as ``to``, special tokens included.

    A column that is called ``to`` in any case gives way. Defined results: null and
    empty lists give an empty text; ids that the vocabulary doesn't have and null
    ids give nothing; bytes that are no UTF-8 become U+FFFD; an empty table gives
    an empty one.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary)
    source, schema = _with_column(tokens, to, T.StringType())
    kept = schema.names[:-1]
    read = ids if ids in source.columns else f"{ids} before"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value.token_bytes)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                lists = part.column(read)
                size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                bounds = np.append(0, np.cumsum(size))
                texts = pa.array(decoder.decode(flat, bounds), pa.binary()).cast(pa.string())
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, texts], [*kept, to])

    return source.mapInArrow(run, schema)
