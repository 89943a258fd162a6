"""Alignment of two tokenizers' tokens over the same texts, and counts of linked ids.

Both token lists of a text cover its bytes. Each gives a dictionary from the byte
offset at which a token ends to the number of tokens up to there. The offsets that
both have cut the text into groups: slices of the two lists that cover the same bytes
and can't be cut further. Within a group every two tokens whose bytes overlap are
linked.

Where both tokenizers always begin a token, whatever stands around, texts are cut into
stretches: before a blank that follows a visible ASCII character. Each distinct stretch
of a few megabytes of text is aligned once. With a model for which that doesn't hold a
text is one stretch.

How often each pair of ids is linked is counted over all texts. To give each text
the counts of its own pairs, texts stay in groups of a few megabytes: a text holds
the places of its pairs in the list of its group, and only these lists are joined to
the counts. Tokenizer files are read by the driver and broadcast; their size doesn't
depend on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from ratewise.llm.bpe import Decoder, Encoder, Vocabulary, distinct, read_vocabulary, take
from ratewise.llm.text import finish, free_prefix, groups_of, text_bytes
from ratewise.session import scratch_path

#: Text bytes of the documents that share a list of pairs.
PART_BYTES = 4 << 20
#: Distinct groups of tokens whose links a task keeps.
CACHED = 1 << 16


@dataclass(frozen=True)
class PieceModel:
    """Contents of a sentencepiece model that puts a blank before each text."""

    data: bytes


Tables = Vocabulary | PieceModel


def read_tokenizer(path: str) -> Tables:
    """What a tokenizer file holds: byte-level BPE as json, or a sentencepiece model."""
    return read_vocabulary(path) if path.endswith(".json") else PieceModel(Path(path).read_bytes())


class ByteTokens:
    """Byte-level BPE of texts that begin with a blank; special tokens are plain text."""

    apart = True

    def __init__(self, vocabulary: Vocabulary):
        self.encode = Encoder(vocabulary, specials=False).encode
        self.decoder = Decoder(vocabulary.token_bytes)


class PieceTokens:
    """Tokens of texts that begin with a blank by a sentencepiece model; special tokens are
    plain text. ``apart``: no piece goes on beyond a blank that follows something else."""

    def __init__(self, model: PieceModel):
        self.model = SentencePieceProcessor(model_proto=model.data)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self.decoder = Decoder({i: self._bytes(i, p) for i, p in enumerate(pieces)})

    def _bytes(self, i: int, piece: str) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        plain = [t[1:].decode("utf-8", "replace") for t in texts]  # the model adds the blank
        found = self.model.encode(plain, num_threads=1)
        ids = np.fromiter(chain.from_iterable(found), np.int32)
        return ids, np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))


def open_tokenizer(tables: Tables) -> ByteTokens | PieceTokens:
    return ByteTokens(tables) if isinstance(tables, Vocabulary) else PieceTokens(tables)


def stretches(texts: list[bytes], cut: bool) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """A blank and each text as one string, with the beginnings and sizes of its stretches
    and the number of the first one of each text.

    A last blank isn't cut off: alone it would be an empty text with its blank.
    """
    whole = b"\n".join(b" " + t for t in texts)
    bounds = np.cumsum([0] + [len(t) + 2 for t in texts])
    begins = np.zeros(len(whole) + 1, bool)
    if cut:
        data = np.frombuffer(whole, np.uint8)
        begins[1:-1] = (data[1:] == 32) & (data[:-1] > 32) & (data[:-1] < 127)
        begins[bounds[1:] - 2] = False
    begins[bounds[:-1]] = True
    first = np.flatnonzero(begins[: len(whole)])
    own = np.searchsorted(first, bounds)
    size = np.diff(np.append(first, bounds[-1]))
    size[own[1:] - 1] -= 1
    return whole, first, size, own


Slice = tuple[tuple[int, ...], tuple[int, ...]]


def common_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """How many tokens of each list end up to each byte offset at which tokens of both end."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1), strict=True))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    ends = sorted(at_a.keys() & at_b.keys())
    return list(map(at_a.__getitem__, ends)), list(map(at_b.__getitem__, ends))


def links(group: Slice, size_a: np.ndarray, size_b: np.ndarray) -> list[tuple[int, int]]:
    """All pairs of tokens of a group whose bytes overlap, in order."""
    a, b = group
    ends_a, ends_b = list(accumulate(size_a[list(a)].tolist())), list(accumulate(size_b[list(b)].tolist()))
    i = j = 0
    found = []
    while i < len(a) and j < len(b):
        found.append((a[i], b[j]))
        step_a, step_b = ends_a[i] <= ends_b[j], ends_b[j] <= ends_a[i]
        i, j = i + step_a, j + step_b
    return found


def text_of(group: Slice) -> str:
    """A group as ``a1,a2|b1``."""
    return "|".join(",".join(map(str, ids)) for ids in group)


def _slice_hashes(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice of ids; slices follow each other and aren't empty."""
    place = np.arange(len(ids)) - np.repeat(first, size)
    mixed = finish((ids.astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64))
    return np.add.reduceat(mixed, first)


@dataclass
class Aligned:
    """Of each text: numbers of ``a`` and ``b`` tokens and of groups, and its groups as text;
    the linked pairs, a number each, of one text after the other, and where each's begin."""

    counts: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    bounds: np.ndarray


class Aligner:
    """Aligns texts; keeps the links of groups that it has met, within a bound."""

    def __init__(self, a: Tables, b: Tables):
        self.a, self.b = open_tokenizer(a), open_tokenizer(b)
        self.size_a, self.size_b = (np.diff(t.decoder.bounds) for t in (self.a, self.b))
        self.expanded: dict[Slice, tuple[str, list[int]]] = {}

    def expand(self, group: Slice) -> tuple[str, list[int]]:
        """A group as text, and its linked pairs, a number each."""
        if group not in self.expanded:
            if len(self.expanded) >= CACHED:
                self.expanded.clear()
            pairs = [(x << 32) | y for x, y in links(group, self.size_a, self.size_b)]
            self.expanded[group] = (text_of(group), pairs)
        return self.expanded[group]

    def align(self, texts: list[bytes]) -> Aligned:
        """Texts that are empty, or whose tokens give other bytes than theirs, have nothing."""
        whole, first, size, own = stretches(texts, self.a.apart and self.b.apart)
        one, kind = distinct(np.frombuffer(whole, np.uint8), first, size)
        ends = (first + size)[one].tolist()
        of = self.align_stretches([whole[i:j] for i, j in zip(first[one].tolist(), ends, strict=True)])
        wrong = np.append(0, np.cumsum(of.counts[kind, 0] == 0))[own]
        good = (np.diff(wrong) == 0) & np.array([len(t) > 0 for t in texts], bool)
        counts = np.append([[0, 0, 0]], np.cumsum(of.counts[kind], axis=0), axis=0)[own]
        listed = list(map(of.groups.__getitem__, kind.tolist()))
        joined = [
            ";".join(listed[i:j]) if ok else ""
            for i, j, ok in zip(own[:-1].tolist(), own[1:].tolist(), good.tolist(), strict=True)
        ]
        n = np.diff(of.bounds)[kind] * np.repeat(good, np.diff(own))
        return Aligned(
            np.diff(counts, axis=0) * good[:, None], joined,
            take(of.pairs, of.bounds[:-1][kind], n), np.append(0, np.cumsum(n))[own],
        )

    def align_stretches(self, words: list[bytes]) -> Aligned:
        """Alignment of texts that begin with a blank."""
        (ids_a, at_a), (ids_b, at_b) = self.a.encode(words), self.b.encode(words)
        whole_a, ends_a = self.a.decoder.spans(ids_a)
        whole_b, ends_b = self.b.decoder.spans(ids_b)
        bounds = np.cumsum([0] + [len(w) for w in words])
        bytes_a, bytes_b = ends_a[at_a], ends_b[at_b]
        if not (whole_a == whole_b == b"".join(words) and (bytes_a == bounds).all() and (bytes_b == bounds).all()):
            return self._align_good(words, whole_a, bytes_a.tolist(), whole_b, bytes_b.tolist())
        # Dictionaries of some thousand tokens at a time stay in the processor's cache.
        to_a, to_b = [], []
        steps = np.unique(np.append(np.searchsorted(at_a, np.arange(0, len(ids_a), 1 << 13)), len(words)))
        for i, j in zip([0, *steps[:-1]], steps, strict=True):
            some_a, some_b = slice(at_a[i] + 1, at_a[j] + 1), slice(at_b[i] + 1, at_b[j] + 1)
            n, m = common_ends(ends_a[some_a].tolist(), ends_b[some_b].tolist())
            to_a.append(np.array(n, np.int64) + at_a[i])
            to_b.append(np.array(m, np.int64) + at_b[i])
        to_a, to_b = np.concatenate(to_a), np.concatenate(to_b)
        first_a, first_b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
        size_a, size_b = to_a - first_a, to_b - first_b
        hashes = finish(_slice_hashes(ids_a, first_a, size_a) ^ finish(_slice_hashes(ids_b, first_b, size_b)))
        _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        made = [
            self.expand((tuple(ids_a[i:k].tolist()), tuple(ids_b[j:m].tolist())))
            for i, k, j, m in zip(*(x[one].tolist() for x in (first_a, to_a, first_b, to_b)), strict=True)
        ]
        names = [t for t, _ in made]
        listed = list(map(names.__getitem__, which.tolist()))
        own = np.searchsorted(to_a, at_a, "right")  # groups up to the end of each stretch
        own[0] = 0
        joined = [";".join(listed[i:j]) for i, j in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)]
        size = np.array([len(p) for _, p in made])
        every = np.array([x for _, p in made for x in p], np.int64)
        pairs = take(every, (np.cumsum(size) - size)[which], size[which])
        counts = np.column_stack([np.diff(at_a), np.diff(at_b), np.diff(own)])
        return Aligned(counts, joined, pairs, np.append(0, np.cumsum(size[which]))[own])

    def _align_good(
        self, words: list[bytes], whole_a: bytes, at_a: list[int], whole_b: bytes, at_b: list[int]
    ) -> Aligned:
        """The same where the tokens of some stretches give other bytes: these have nothing."""
        good = [
            i
            for i, w in enumerate(words)
            if whole_a[at_a[i] : at_a[i + 1]] == w == whole_b[at_b[i] : at_b[i + 1]]
        ]
        counts, n, groups = np.zeros((len(words), 3), np.int64), np.zeros(len(words), np.int64), [""] * len(words)
        found = self.align_stretches([words[i] for i in good]) if good else None
        if found:
            counts[good], n[good] = found.counts, np.diff(found.bounds)
            for i, text in zip(good, found.groups, strict=True):
                groups[i] = text
        pairs = found.pairs if found else np.empty(0, np.int64)
        return Aligned(counts, groups, pairs, np.append(0, np.cumsum(n)))


def align(
    docs: DataFrame, a: Tables, b: Tables, text: str = "text", prefix: str = "_"
) -> DataFrame:
    """The rows of ``docs`` with the alignment of their text's tokens of ``a`` and ``b``.

    Added, with ``prefix`` before: ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``,
    ``groups`` (ids of each group as ``a1,a2|b1;a3|b2,b3``), and what ``link_counts``
    takes: ``part``, the documents that share a list of pairs; ``own``, the places of
    the text's pairs in that list, and ``times``, how often it has each; ``pairs`` and
    ``pair_times``, the list itself, on one row of the part.

    Both tokenizers must stand for the same bytes: a blank and the text. Defined
    results: texts that are null or empty, or whose tokens of one tokenizer give other
    bytes, have no tokens, so zeros and empty ``groups``; repeated rows each get their
    row; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast((a, b))
    integers, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    added = [
        ("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()),
        ("n_links", T.LongType()), ("groups", T.StringType()), ("part", T.LongType()),
        ("own", integers), ("times", integers), ("pairs", longs), ("pair_times", longs),
    ]
    given = docs.columns
    names = [*given, *(prefix + n for n, _ in added)]
    schema = T.StructType([*docs.schema, *(T.StructField(prefix + n, k) for n, k in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = text_bytes(batch.column(text))
            for start, stop in groups_of(texts, PART_BYTES):
                found = aligner.align(texts[start:stop])
                every, place = np.unique(found.pairs, return_inverse=True)
                own = [
                    np.unique(place[i:j], return_counts=True)
                    for i, j in zip(found.bounds[:-1], found.bounds[1:], strict=True)
                ]
                rest = [None] * (stop - start - 1)
                totals = np.bincount(place, minlength=len(every))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(start, stop - start) for c in given),
                        *(pa.array(found.counts[:, k]) for k in range(3)),
                        pa.array(np.diff(found.bounds)),
                        pa.array(found.groups, pa.string()),
                        pa.array(np.full(stop - start, part), pa.int64()),
                        pa.array([p for p, _ in own], pa.list_(pa.int32())),
                        pa.array([n for _, n in own], pa.list_(pa.int32())),
                        pa.array([every, *rest], pa.list_(pa.int64())),
                        pa.array([totals, *rest], pa.list_(pa.int64())),
                    ],
                    names,
                )
                part += 1

    return docs.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, prefix: str = "_") -> DataFrame:
    """(a, b, n, best): how often each two ids are linked in all texts, and whether no
    other id of ``a`` is linked more often with that ``b``."""
    pair = F.explode(F.arrays_zip(F.col(f"{prefix}pairs"), F.col(f"{prefix}pair_times"))).alias("x")
    counts = (
        aligned.filter(F.col(f"{prefix}pairs").isNotNull())
        .select(pair)
        .groupBy(F.col(f"x.{prefix}pairs").alias("pair"))
        .agg(F.sum(f"x.{prefix}pair_times").alias("n"))
        .select(
            F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(2**32 - 1).alias("b"), "n"
        )
    )
    path = scratch_path(aligned.sparkSession, "pair-counts")
    counts.write.parquet(path)
    counts = aligned.sparkSession.read.parquet(path)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def link_counts(aligned: DataFrame, prefix: str = "_") -> DataFrame:
    """The rows of ``aligned`` with ``n_best`` and ``count_sum`` (with ``prefix`` before)
    in place of the columns that only serve this: links whose pair is a ``best`` one of
    ``pair_counts``, and the sum of the counts of all links.

    ``aligned`` is what ``align`` gives, less any columns of no use further on. It is
    written once, as both the counts and the rows come from it.
    """
    spark = aligned.sparkSession
    path = scratch_path(spark, "aligned")
    aligned.write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    part, pairs = f"{prefix}part", f"{prefix}pairs"
    counts = pair_counts(rows, prefix)
    listed = rows.filter(F.col(pairs).isNotNull()).select(
        F.col(part).alias("part"), F.posexplode(pairs).alias("place", "pair")
    )
    wanted = listed.select(
        "part", "place",
        F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(2**32 - 1).alias("b"),
    )
    found = wanted.join(counts, ["a", "b"]).select("part", "place", "n", "best")
    serving = {f"{prefix}{c}" for c in ("part", "own", "times", "pairs", "pair_times")}
    kept = [c for c in rows.columns if c not in serving]
    schema = T.StructType(
        [
            *(f for f in rows.schema if f.name in kept),
            T.StructField(f"{prefix}n_best", T.LongType()),
            T.StructField(f"{prefix}count_sum", T.LongType()),
        ]
    )

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        n = np.zeros(len(place) + 1, np.int64)
        best = np.zeros(len(place) + 1, np.int64)
        n[place] = right.column("n").to_numpy()
        best[place] = right.column("best").to_numpy()
        own = left.column(f"{prefix}own").combine_chunks()
        times = left.column(f"{prefix}times").combine_chunks().flatten().to_numpy().astype(np.int64)
        at = own.flatten().to_numpy()
        bounds = np.append(0, np.cumsum(own.value_lengths().to_numpy()))
        n_best = np.append(0, np.cumsum(best[at] * times))[bounds]
        total = np.append(0, np.cumsum(n[at] * times))[bounds]
        new = [pa.array(np.diff(n_best)), pa.array(np.diff(total))]
        return pa.table([*(left.column(c) for c in kept), *new], names=schema.names)

    return rows.drop(pairs, f"{prefix}pair_times").groupBy(part).cogroup(
        found.groupBy("part")
    ).applyInArrow(look_up, schema)


def align_and_count(
    docs: DataFrame, a: Tables, b: Tables, text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with ``align``'s counts and groups and ``link_counts``' sums,
    under a prefix that no column of theirs begins with."""
    prefix = free_prefix(docs.columns)
    return link_counts(align(docs, a, b, text, prefix), prefix)
