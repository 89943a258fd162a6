"""Passages that an earlier document has, found by seed and extend.

Seeds are winnowed: of the 18-word runs of each 50-word window, the one with the
smallest hash is its anchor, so equal windows have their anchor at the same
place. An anchor is extended by 32 words to both sides, which holds every window
it can be the anchor of; documents are joined on anchors, and where the whole
context is equal, the match is. Anchors with several contexts are extended word
by word: their contexts' windows are compared, each as often as there are
different contexts, never pair by pair. Matched windows that touch or overlap
are one maximal repeat.

Contexts and windows are compared by 128-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.decontamination import fingerprint_filter
from ratewise.llm.text import (
    WordHash,
    block_count,
    block_of,
    finish,
    groups_of,
    split_words,
    text_bytes,
)
from ratewise.session import scratch_path

_FIRST, _SECOND = WordHash(101), WordHash(202)
_INVERSE = [pow(int(w.base), -1, 2**64) for w in (_FIRST, _SECOND)]


@dataclass(frozen=True)
class Lengths:
    """A window, the run of words that can be its anchor, and what is left beside that."""

    window: int = 50
    run: int = 18

    @property
    def side(self) -> int:
        return self.window - self.run


class _Ranges:
    """Hashes of word ranges of one sequence, from sums of hashes times powers."""

    def __init__(self, hashes: np.ndarray, by: WordHash, inverse: int):
        n = len(hashes)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * by.power(n + 1)[:n])])
        back = np.full(n + 1, np.uint64(inverse))
        back[0] = 1
        self.back = np.multiply.accumulate(back)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return finish((self.sums[end] - self.sums[begin]) * self.back[begin])


@dataclass
class _Anchors:
    """Anchors of some texts, by place in their common word sequence."""

    place: np.ndarray
    text: np.ndarray
    begin: np.ndarray  # of the anchor's text
    end: np.ndarray
    seed: np.ndarray
    key: np.ndarray  # context, first half
    key2: np.ndarray
    ranges: list[_Ranges]


def _anchors(texts: list[bytes], sizes: Lengths) -> tuple[_Anchors, np.ndarray]:
    """Anchors of the texts, and the bounds of the texts among the words."""
    words = split_words(texts)
    hashes = words.hashes(_FIRST)
    ranges = [
        _Ranges(hashes, _FIRST, _INVERSE[0]),
        _Ranges(words.hashes(_SECOND), _SECOND, _INVERSE[1]),
    ]
    bounds = words.bounds
    counts = np.maximum(np.diff(bounds) - sizes.window + 1, 0)
    empty = np.empty(0, np.int64)
    if not counts.sum():
        none = np.empty(0, np.uint64)
        return _Anchors(empty, empty, empty, empty, none, none, none, ranges), bounds
    seeds = _FIRST.runs(hashes, sizes.run)
    begins = np.repeat(bounds[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    least = np.lib.stride_tricks.sliding_window_view(seeds, sizes.side + 1)
    place = np.unique(begins + least[begins].argmin(axis=1))
    text = np.searchsorted(bounds, place, side="right") - 1
    begin, end = bounds[text], bounds[text + 1]
    left = np.maximum(begin, place - sizes.side)
    right = np.minimum(end, place + sizes.window)
    shape = ((place - left) << 20 | (right - place)).astype(np.uint64)
    key, key2 = (finish(r.of(left, right) ^ shape) for r in ranges)
    return _Anchors(place, text, begin, end, seeds[place], key, key2, ranges), bounds


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _contexts(docs: DataFrame, sizes: Lengths) -> DataFrame:
    """(block, doc_id, seed, key, key2) of each document's anchors, each once."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            for a, b in groups_of(texts):
                found, _ = _anchors(texts[a:b], sizes)
                order = np.lexsort((found.key2, found.key, found.text))
                k, k2, t = found.key[order], found.key2[order], found.text[order]
                fresh = np.ones(len(order), bool)
                fresh[1:] = (k[1:] != k[:-1]) | (k2[1:] != k2[:-1]) | (t[1:] != t[:-1])
                pick = order[fresh]
                at = found.text[pick] + a
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(blocks[at], pa.int32()),
                        pa.array(ids[at], pa.int64()),
                        _signed(found.seed[pick]),
                        _signed(found.key[pick]),
                        _signed(found.key2[pick]),
                    ],
                    ["block", "doc_id", "seed", "key", "key2"],
                )

    return docs.filter("doc_id is not null").mapInArrow(
        find, "block int, doc_id bigint, seed bigint, key bigint, key2 bigint"
    )


class _Table:
    """Rows of a block's context table, found by both halves of the key."""

    def __init__(self, table: pa.Table):
        key, key2 = (
            table.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("key", "key2")
        )
        self.order = np.argsort(key, kind="stable")
        self.key, self.key2 = key[self.order], key2[self.order]

    def rows(self, key: np.ndarray, key2: np.ndarray) -> np.ndarray:
        """Row of each key, or -1. Equal first halves with other second halves don't occur
        in practice (64 bits); were there one, its row would count as absent."""
        if not len(self.key):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        same = (self.key[at] == key) & (self.key2[at] == key2)
        return np.where(same, self.order[at], -1)


def _extended(docs: DataFrame, wanted: DataFrame, sizes: Lengths) -> DataFrame:
    """Windows (w1, w2) of the wanted (block, context, key, key2, least), by their offset."""

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        table, least = _Table(right), right.column("least").to_numpy()
        context = right.column("context").to_numpy()
        texts = text_bytes(left.column("text"))
        out, done = [], np.zeros(right.num_rows, bool)
        for a, b in groups_of(texts):
            found, _ = _anchors(texts[a:b], sizes)
            row = table.rows(found.key, found.key2)
            row, first = np.unique(row, return_index=True)
            fresh = (row >= 0) & ~done[row]
            row, at = row[fresh], first[fresh]
            done[row] = True
            start = found.place[at][:, None] + np.arange(-sizes.side, 1)[None, :]
            fits = (start >= found.begin[at][:, None]) & (
                start + sizes.window <= found.end[at][:, None]
            )
            which, offset = np.nonzero(fits)
            start = start[fits]
            w1, w2 = (r.of(start, start + sizes.window) for r in found.ranges)
            out.append(
                pa.table(
                    {
                        "w1": _signed(w1),
                        "w2": _signed(w2),
                        "least": pa.array(least[row[which]], pa.int64()),
                        "context": pa.array(context[row[which]], pa.int64()),
                        "offset": pa.array(offset.astype(np.int32)),
                    }
                )
            )
        return pa.concat_tables(out) if out else schema.empty_table()

    names = ["w1", "w2", "least", "context"]
    schema = pa.schema([(n, pa.int64()) for n in names] + [("offset", pa.int32())])
    return (
        docs.groupBy("block")
        .cogroup(wanted.groupBy("block"))
        .applyInArrow(find, ", ".join(f"{n} bigint" for n in names) + ", offset int")
    )


def _covered(found: _Anchors, row: np.ndarray, ids, least, mask, sizes: Lengths, n: int):
    """Which of the n words lie in a window of a smaller document."""
    hit = np.flatnonzero(row >= 0)
    row = row[hit]
    place, begin, end = found.place[hit], found.begin[hit], found.end[hit]
    later = ids[found.text[hit]] > least[row]
    edges = np.zeros(n + 1, np.int64)
    # The whole context is known from a smaller document: all its windows are.
    first = np.maximum(begin, place - sizes.side)[later]
    last = np.minimum(place + sizes.window, end)[later]
    np.add.at(edges, first, 1)
    np.add.at(edges, last, -1)
    # This is the context's first document: single windows may be known from others.
    bits = mask[row][:, None] >> np.arange(sizes.side + 1)[None, :] & 1
    start = place[:, None] + np.arange(-sizes.side, 1)[None, :]
    fits = (bits == 1) & ~later[:, None]
    fits &= (start >= begin[:, None]) & (start + sizes.window <= end[:, None])
    np.add.at(edges, start[fits], 1)
    np.add.at(edges, start[fits] + sizes.window, -1)
    return np.cumsum(edges[:-1]) > 0


def remove_repeats(docs: DataFrame, sizes: Lengths = Lengths()) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) for each row of ``docs`` (doc_id, text).

    A word goes if it lies in a window that also starts in a document with a
    smaller doc_id. ``spans`` are the maximal removed repeats (first word, past
    the last), ``kept`` the other words joined by one blank. Defined results:
    null and empty texts, and those shorter than a window, lose nothing; rows
    that share a doc_id, equal ones too, don't remove from each other; a row
    with a null doc_id is returned whole and removes nothing; the windows are
    those of the input, not of what is left; an empty table gives an empty one.
    """
    if sizes.side > 62:
        raise ValueError("a window may exceed its run by 62 words at most")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = block_count(rows)
    rows = rows.withColumn("block", block_of(["doc_id", "text"], blocks))

    path = scratch_path(spark, "contexts")
    _contexts(rows, sizes).write.parquet(path)
    contexts = spark.read.parquet(path)
    shared = (
        contexts.groupBy("seed")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high")
        .select("seed")
    )
    path = scratch_path(spark, "shared-seeds")
    shared.write.parquet(path)
    shared = spark.read.parquet(path)
    path = scratch_path(spark, "shared-contexts")
    contexts.join(shared, "seed").write.parquet(path)
    contexts = spark.read.parquet(path)

    kinds = contexts.groupBy("seed", "key", "key2").agg(
        F.min(F.struct("doc_id", "block")).alias("holder"), F.max("doc_id").alias("high")
    )
    path = scratch_path(spark, "distinct-contexts")
    kinds.select(
        F.monotonically_increasing_id().alias("context"),  # holds once it is written
        "seed", "key", "key2", F.col("holder.doc_id").alias("least"), "holder.block", "high"
    ).write.parquet(path)
    kinds = spark.read.parquet(path)
    several = kinds.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    wanted = kinds.join(several, "seed").select("block", "context", "key", "key2", "least")

    path = scratch_path(spark, "wanted-contexts")
    wanted.write.parquet(path)
    wanted = spark.read.parquet(path)
    # Few documents hold them; a bit map of fixed size passes over most others.
    holder = fingerprint_filter(wanted.select(F.xxhash64("least").alias("fp")))
    path = scratch_path(spark, "context-windows")
    _extended(rows.filter(holder(F.xxhash64("doc_id"))), wanted, sizes).write.parquet(path)
    windows = spark.read.parquet(path)
    known = windows.groupBy("w1", "w2").agg(
        F.min("least").alias("first"), F.max("least").alias("last")
    ).filter("first < last")
    # Written, so that the join starts from plain rows and a frequent window can be split.
    path = scratch_path(spark, "known-windows")
    known.write.parquet(path)
    known = spark.read.parquet(path)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("offset"))
    masks = (
        windows.join(known, ["w1", "w2"])
        .filter("first < least")
        .groupBy("context")
        .agg(F.bit_or(bit).alias("mask"))
    )
    verdicts = (
        kinds.join(masks, "context", "left")
        .withColumn("mask", F.coalesce("mask", F.lit(0).cast("bigint")))
        .filter("mask <> 0 or high > least")
        .select("seed", "key", "key2", "least", "mask")
    )
    # Each block gets the contexts it has, each once.
    of_block = contexts.groupBy("seed", "key", "key2", "block").agg(F.max("doc_id").alias("top"))
    per_block = (
        of_block.join(verdicts, ["seed", "key", "key2"])
        .filter("mask <> 0 or top > least")
        .select("block", "key", "key2", "least", "mask")
    )

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        table = _Table(right)
        least, mask = right.column("least").to_numpy(), right.column("mask").to_numpy()
        texts = text_bytes(left.column("text"))
        no_id = left.column("doc_id").is_null().to_numpy()
        ids = left.column("doc_id").fill_null(0).to_numpy()
        counts, removed, spans, kept = [], [], [], []
        for a, b in groups_of(texts):
            if len(table.key):
                found, bounds = _anchors(texts[a:b], sizes)
                row = table.rows(found.key, found.key2)
                row[no_id[a:b][found.text]] = -1
                gone = _covered(found, row, ids[a:b], least, mask, sizes, int(bounds[-1]))
            for i in range(a, b):
                words = texts[i].split()
                lost = gone[bounds[i - a] : bounds[i - a + 1]] if len(table.key) else None
                if lost is not None and lost.any():
                    edge = np.flatnonzero(np.diff(lost.astype(np.int8), prepend=0, append=0))
                    spans.append([{"first": x, "past": y} for x, y in edge.reshape(-1, 2).tolist()])
                    removed.append(int(lost.sum()))
                    counts.append(len(words))
                    words = [w for w, out in zip(words, lost.tolist()) if not out]
                else:
                    spans.append([])
                    removed.append(0)
                    counts.append(len(words))
                kept.append(b" ".join(words).decode())
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, span),
                "kept": pa.array(kept, pa.string()),
            }
        )

    span = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))
    return (
        rows.groupBy("block")
        .cogroup(per_block.groupBy("block"))
        .applyInArrow(
            cut,
            "doc_id bigint, n_words bigint, n_removed bigint, "
            "spans array<struct<first:int,past:int>>, kept string",
        )
    )
