"""Hashed maximum-entropy language model with a class-factored softmax.

A token's class is predicted from hashed features of the tokens before it: the
last one, the last two together, the last but one and the last but two (skips).
The ``head`` most frequent tokens have classes of ``slots`` by frequency and are
predicted within their class from hashed features of class and last token. Any
other token belongs to a class by its surface (length, last byte, bytes above
7F), and within that has the probability of its training count, discounted; the
discount is the probability of words not seen in training. So the probabilities
of all known tokens and one unknown token add up to one.

Counts cover all training tokens and are looked up by a join. The weights have a
fixed size. They are trained by rounds of distributed gradient updates: in a
round every task makes gradient steps over its share of the training texts, and
the changes are averaged row by row, weighted by the tokens that touched a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.text import (
    WordHash,
    Words,
    block_count,
    block_of,
    finish,
    groups_of,
    split_words,
    text_bytes,
)
from ratewise.session import scratch_path

_HASH = WordHash(505)
#: Stands for the end of a text; no word has this hash but by a 64-bit chance.
END = np.uint64(0x5EED_0E4D_0F7E_4701)
_START = np.uint64(1)


@dataclass(frozen=True)
class Shape:
    """Sizes and steps; none depends on the documents."""

    slots: int = 32
    head_classes: int = 32
    tail_classes: int = 24
    bits: int = 14  # 2 ** bits rows of class weights, and as many within classes
    rounds: int = 2
    batch: int = 2048
    rate: float = 2.0

    @property
    def head(self) -> int:
        return self.slots * self.head_classes

    @property
    def classes(self) -> int:
        return self.head_classes + self.tail_classes


@dataclass
class Tokens:
    """Tokens of some texts, each closed by its end token."""

    hashes: np.ndarray
    surface: np.ndarray  # tail class the token would belong to
    bounds: np.ndarray


def surface_class(words: Words, n: int) -> np.ndarray:
    """Class of words by length, last byte and whether a byte is above 7F."""
    if not len(words.first):
        return np.empty(0, np.int64)
    last = words.data[words.first + words.length - 1]
    mark = (last < 48) | ((last > 57) & (last < 97))
    wide = np.maximum.reduceat(words.data, words.first) > 127
    size = np.digitize(words.length, (4, 6, 8, 11, 15))
    return (size * 4 + mark * 2 + wide) % n


def tokens(texts: list[bytes], shape: Shape) -> Tokens:
    """Lower-cased words and ends of the texts."""
    words = split_words([t.lower() for t in texts])
    bounds = words.bounds + np.arange(len(words.bounds))
    hashes = np.full(int(bounds[-1]), END, np.uint64)
    surface = np.zeros(len(hashes), np.int64)
    inside = np.ones(len(hashes), bool)
    inside[bounds[1:] - 1] = False
    hashes[inside] = words.hashes(_HASH)
    surface[inside] = surface_class(words, shape.tail_classes)
    return Tokens(hashes, surface, bounds)


def _rows(t: Tokens, shape: Shape) -> list[np.ndarray]:
    """Hashed rows of the features of each token's history."""
    starts = np.repeat(t.bounds[:-1], np.diff(t.bounds))
    place = np.arange(len(t.hashes)) - starts
    before = []
    for k in (1, 2, 3):
        h = np.full(len(t.hashes), _START, np.uint64)
        h[k:] = t.hashes[:-k] if k < len(h) else h[k:]
        h[place < k] = _START
        before.append(h)
    last, second, third = before
    kinds = (
        last,
        finish(second + np.uint64(2)),
        finish(third + np.uint64(3)),
        finish(last * np.uint64(0x9E3779B97F4A7C15) + second),
    )
    return [(finish(h) >> np.uint64(64 - shape.bits)).astype(np.int64) for h in kinds]


@dataclass
class Model:
    """Head tokens, tail classes and weights. Its size is set by its shape."""

    shape: Shape
    head: np.ndarray  # hashes of the head tokens, sorted
    rank: np.ndarray  # their ranks by frequency
    head_counts: np.ndarray  # training counts by rank
    tail_tokens: np.ndarray  # training tokens, kinds and discount of the tail classes
    tail_kinds: np.ndarray
    tail_cut: np.ndarray
    bias: np.ndarray  # log share of each class
    slot_bias: np.ndarray  # log share of each head token in its class
    weights: np.ndarray | None = None  # by row, of the classes
    slot_weights: np.ndarray | None = None  # by row, of the slots of a class

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of head tokens, -1 for others."""
        if not len(self.head):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
        return np.where(self.head[at] == hashes, self.rank[at], -1)

    def classes(self, t: Tokens, rank: np.ndarray) -> np.ndarray:
        return np.where(rank >= 0, rank // self.shape.slots, self.shape.head_classes + t.surface)

    def slot_rows(self, rows: list[np.ndarray], cls: np.ndarray) -> np.ndarray:
        """Row of the weights within a class: of the class and the last token."""
        mixed = finish((rows[0] * 64 + cls).astype(np.uint64))
        return (mixed >> np.uint64(64 - self.shape.bits)).astype(np.int64)

    def empty_weights(self) -> None:
        n = 1 << self.shape.bits
        self.weights = np.zeros((n, self.shape.classes), np.float32)
        self.slot_weights = np.zeros((n, self.shape.slots), np.float32)

    def tail_log(self, cls: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log probability, within its tail class, of a token of this count."""
        k = cls - self.shape.head_classes
        n = np.maximum(self.tail_tokens[k], 1)
        known = np.maximum(counts - self.tail_cut[k], 1e-300) / n
        unseen = np.where(
            self.tail_tokens[k] > 0, self.tail_cut[k] * self.tail_kinds[k] / n, 1.0
        )
        return np.log(np.where(counts > 0, known, np.maximum(unseen, 1e-300)))


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _class_scores(model: Model, rows: list[np.ndarray]) -> np.ndarray:
    z = model.bias + model.weights.take(rows[0], axis=0)
    for r in rows[1:]:
        z += model.weights.take(r, axis=0)
    return z


def log10_scores(model: Model, t: Tokens, counts: np.ndarray, step: int = 2048) -> np.ndarray:
    """Log10 probability of each token, given the training counts of the tail tokens."""
    rank, rows = model.ranks(t.hashes), _rows(t, model.shape)
    cls = model.classes(t, rank)
    slot_row = model.slot_rows(rows, cls)
    out = np.empty(len(t.hashes))
    for a in range(0, len(out), step):
        part = slice(a, min(a + step, len(out)))
        every = np.arange(part.stop - a)
        p = _softmax(_class_scores(model, [r[part] for r in rows]))[every, cls[part]]
        total = np.log(np.maximum(p, 1e-30), dtype=np.float64)
        head = np.flatnonzero(rank[part] >= 0)
        c, r = cls[part][head], rank[part][head]
        q = _softmax(model.slot_bias[c] + model.slot_weights[slot_row[part][head]])
        total[head] += np.log(np.maximum(q[np.arange(len(head)), r % model.shape.slots], 1e-30))
        tail = np.flatnonzero(rank[part] < 0)
        total[tail] += model.tail_log(cls[part][tail], counts[part][tail])
        out[part] = total
    return out / np.log(10)


def _add(table: np.ndarray, rows: list[np.ndarray], steps: np.ndarray, seen: np.ndarray) -> None:
    """Take a batch's steps off the rows of its features, and count their tokens."""
    every = np.concatenate(rows)
    if len(table) <= 1 << 16:
        every = every.astype(np.uint16)  # sorted by counting
    order = np.argsort(every, kind="stable")
    place = every[order]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    times = np.diff(np.append(first, len(place)))
    often = np.argsort(-times, kind="stable")
    first, times = first[often], times[often]
    at, which = place[first].astype(np.int64), order % len(steps)
    steps = steps.astype(np.float64)
    total = steps.take(which[first], axis=0)
    # The k-th steps of all rows that have so many at once; those of the few with more by row.
    more = np.searchsorted(-times, -np.arange(times[0] + 1))  # rows with more than k steps
    k = 1
    while more[k] > 24:
        total[: more[k]] += steps.take(which[first[: more[k]] + k], axis=0)
        k += 1
    for i in range(more[k]):
        total[i] += steps[which[first[i] + k : first[i] + times[i]]].sum(axis=0)
    seen[at] += times
    # AdaGrad's shape without its table: steps shrink with what a row has seen.
    shrunk = np.sqrt(times * seen[at])[:, None]
    for a in range(0, len(at), 512):
        part = slice(a, a + 512)
        kept = table.take(at[part], axis=0).astype(np.float64)
        kept -= total[part] / shrunk[part]
        table[at[part]] = kept


def learn(model: Model, texts: list[bytes], seen: np.ndarray, slot_seen: np.ndarray) -> None:
    """Gradient steps over the texts, on the weights of ``model``."""
    shape, rate = model.shape, np.float32(model.shape.rate)
    t = tokens(texts, shape)
    rank, rows = model.ranks(t.hashes), _rows(t, shape)
    cls = model.classes(t, rank)
    slot_row = model.slot_rows(rows, cls)
    for a in range(0, len(rank), shape.batch):
        part = slice(a, min(a + shape.batch, len(rank)))
        own = [r[part] for r in rows]
        g = _softmax(_class_scores(model, own))
        g[np.arange(len(g)), cls[part]] -= 1
        g *= rate / len(own)
        _add(model.weights, own, g, seen)
        head = np.flatnonzero(rank[part] >= 0)
        if len(head):
            c, r = cls[part][head], slot_row[part][head]
            g = _softmax(model.slot_bias[c] + model.slot_weights[r])
            g[np.arange(len(g)), rank[part][head] % shape.slots] -= 1
            _add(model.slot_weights, [r], g * rate, slot_seen)


def count_tokens(docs: DataFrame, shape: Shape) -> DataFrame:
    """(token, surface, n) of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for a, b in groups_of(texts, 4 << 20):
                t = tokens(texts[a:b], shape)
                token, first, n = np.unique(t.hashes, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token.view(np.int64)),
                        pa.array(t.surface[first], pa.int32()),
                        pa.array(n),
                    ],
                    ["token", "surface", "n"],
                )

    rows = docs.select("text").mapInArrow(count, "token bigint, surface int, n bigint")
    return rows.groupBy("token").agg(F.sum("n").alias("n"), F.min("surface").alias("surface"))


def prepare(counts: DataFrame, shape: Shape) -> tuple[Model, int, int]:
    """Model without weights from the counts (token, surface, n); training tokens, kinds."""
    top = counts.orderBy(F.desc("n"), "token").limit(shape.head).toPandas()
    hashes = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    n = np.zeros(shape.head)
    n[: len(top)] = top["n"]
    once = F.sum((F.col("n") == 1).cast("bigint"))
    twice = F.sum((F.col("n") == 2).cast("bigint"))
    by_class = (  # as many rows as there are tail classes, and the END token's
        counts.groupBy("surface")
        .agg(F.sum("n"), F.count("*"), once, twice)
        .collect()
    )
    whole = np.zeros((shape.tail_classes, 4))
    for row in by_class:
        whole[row[0]] += [float(x) for x in row[1:]]
    total, kinds = int(whole[:, 0].sum()), int(whole[:, 1].sum())
    if len(top):  # the head tokens leave the tail classes
        surface = top["surface"].to_numpy(np.int64)
        np.subtract.at(whole[:, 0], surface, n[: len(top)])
        np.subtract.at(whole[:, 1], surface, 1)
        for k in (1, 2):
            np.subtract.at(whole[:, k + 1], surface, n[: len(top)] == k)
    tail, tail_kinds, n1, n2 = whole.T
    cut = np.where(n1 > 0, n1 / np.maximum(n1 + 2 * n2, 1), 0.5)
    cut = np.clip(cut, 0.1, 0.9)
    head = n.reshape(shape.head_classes, shape.slots)
    share = np.concatenate([head.sum(axis=1), tail]) + 0.5
    slots = np.where(head > 0, np.log(np.maximum(head, 1)), -60)
    model = Model(
        shape, hashes[order], order.astype(np.int64), n, tail, tail_kinds, cut,
        np.log(share / share.sum()).astype(np.float32), slots.astype(np.float32),
    )
    return model, total, kinds


def _slices(model: Model) -> int:
    """The weights travel in slices of rows of about half a megabyte."""
    return max(1, (1 << model.shape.bits) * (model.shape.classes + model.shape.slots) * 4 >> 19)


def train_round(docs: DataFrame, shared: Broadcast, shape: Shape, slices: int) -> DataFrame:
    """(slice, sums): changes of the weights by the texts, times the tokens of each row.

    A task gives its changes once. They are added up in two levels, so that a
    task of the first holds about the square root of their number.
    """
    n = 1 << shape.bits
    parts = max(1, round(docs.rdd.getNumPartitions() ** 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start: Model = shared.value
        model = Model(**{**start.__dict__, "weights": start.weights.copy(),
                         "slot_weights": start.slot_weights.copy()})
        seen, slot_seen = np.zeros(n, np.float32), np.zeros(n, np.float32)
        mark = 0
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for a, b in groups_of(texts):
                learn(model, texts[a:b], seen, slot_seen)
                mark = (mark * 31 + len(texts[a])) % 1_000_003
        if not seen.any():
            return
        change = np.concatenate(
            [
                (model.weights - start.weights) * seen[:, None],
                (model.slot_weights - start.slot_weights) * slot_seen[:, None],
                seen[:, None],
                slot_seen[:, None],
            ],
            axis=1,
        )
        for i, part in enumerate(np.array_split(change, slices)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([mark % parts], pa.int32()),
                 pa.array([part.tobytes()], pa.binary())],
                ["slice", "part", "sums"],
            )

    def add(table: pa.Table) -> pa.Table:
        total, *rest = sorted(table.column("sums").to_pylist())  # in an order of their own
        total = np.frombuffer(total, np.float32).astype(np.float64)
        for x in rest:
            total += np.frombuffer(x, np.float32)
        return pa.table(
            {
                "slice": table.column("slice")[:1],
                "part": pa.array([0], pa.int32()),
                "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary()),
            }
        )

    schema = "slice int, part int, sums binary"
    changes = docs.select("text").mapInArrow(run, schema)
    first = changes.groupBy("slice", "part").applyInArrow(add, schema)
    return first.groupBy("slice").applyInArrow(add, schema).select("slice", "sums")


def train(docs: DataFrame, model: Model) -> Model:
    """The model with weights, after its rounds over the texts, each text in one of them."""
    shape, spark = model.shape, docs.sparkSession
    model.empty_weights()
    slices = _slices(model)
    width = shape.classes + shape.slots + 2
    of_round = F.pmod(F.xxhash64("text", "doc_id"), F.lit(shape.rounds))
    for k in range(shape.rounds):
        shared = spark.sparkContext.broadcast(model)
        rows = train_round(docs.filter(of_round == k), shared, shape, slices).collect()
        if not rows:
            continue
        held = {r[0]: np.frombuffer(r[1], np.float32).reshape(-1, width) for r in rows}
        change = np.concatenate([held[i] for i in range(slices)])
        for table, sums, seen in (
            ("weights", change[:, : shape.classes], change[:, -2:-1]),
            ("slot_weights", change[:, shape.classes : -2], change[:, -1:]),
        ):
            mean = np.divide(sums, seen, out=np.zeros_like(sums), where=seen > 0)
            setattr(model, table, getattr(model, table) + mean)
    return model


def score(docs: DataFrame, held_out: Column, shape: Shape = Shape()) -> DataFrame:
    """Scores of each row of ``docs`` (doc_id, text) by a model of the rows not held out.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, the last two log10 probabilities of the whole text, by add-one counts
    and by the model. Defined results: null and empty texts are one end token; a
    null ``held_out`` counts as false; repeated rows each get their row, and
    count twice in training; without training texts all words are unknown and
    only the end counts, as unknown as they; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    blocks = block_count(rows)
    training = rows.filter(~F.col("held_out"))
    path = scratch_path(spark, "token-counts")
    count_tokens(training, shape).write.parquet(path)
    counts = spark.read.parquet(path)
    model, total, kinds = prepare(counts, shape)
    shared = spark.sparkContext.broadcast(train(training, model))

    blocked = rows.withColumn("block", block_of(["doc_id", "text"], blocks))

    def needed(table: pa.Table) -> pa.Table:
        """The distinct tokens of a block."""
        texts, found = text_bytes(table.column("text")), []
        for a, b in groups_of(texts):
            found.append(np.unique(tokens(texts[a:b], shape).hashes))
        token = np.unique(np.concatenate(found))
        block = pa.array(np.full(len(token), table.column("block")[0].as_py(), np.int32))
        return pa.table({"block": block, "token": pa.array(token.view(np.int64))})

    wanted = blocked.groupBy("block").applyInArrow(needed, "block int, token bigint")
    looked_up = wanted.join(counts.select("token", "n"), "token")

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        model = shared.value
        token = right.column("token").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(token)
        token, n = token[order], right.column("n").to_numpy()[order]
        texts = text_bytes(left.column("text"))
        unknown = np.log10(1 / (total + kinds + 1))
        sizes, known, base, scores = [], [], [], []
        for a, b in groups_of(texts):
            t = tokens(texts[a:b], shape)
            count = np.zeros(len(t.hashes), np.int64)
            if len(token):
                at = np.minimum(np.searchsorted(token, t.hashes), len(token) - 1)
                count = np.where(token[at] == t.hashes, n[at], 0)
            first = t.bounds[:-1]
            sizes.append(np.diff(t.bounds))
            known.append(np.add.reduceat((count > 0).astype(np.int64), first))
            base.append(np.add.reduceat(np.log10(count + 1.0) + unknown, first))
            scores.append(np.add.reduceat(log10_scores(model, t, count), first))
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "held_out": left.column("held_out"),
                "n_tokens": pa.array(np.concatenate(sizes), pa.int64()),
                "n_known": pa.array(np.concatenate(known), pa.int64()),
                "train_tokens": pa.array(np.full(left.num_rows, total, np.int64)),
                "base_score": pa.array(np.concatenate(base)),
                "score": pa.array(np.concatenate(scores)),
            }
        )

    return (
        blocked.groupBy("block")
        .cogroup(looked_up.groupBy("block"))
        .applyInArrow(
            measure,
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
            "train_tokens bigint, base_score double, score double",
        )
    )
