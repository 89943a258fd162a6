"""Toxicity classifier that doesn't lean on the mention of groups.

Hashed logistic regression on which words and word beginnings a text has. For
each labelled text that names a group the term is swapped for another of its kind,
and the change of the score is penalised, so that mentions alone carry no weight.
The terms are ``IDENTITY_TERMS`` and those that ``find_terms`` finds in the rows
that are learnt from: words that the labels lean on, though most texts with them
are harmless.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.text import WordHash, free_prefix, groups_of, split_words, text_bytes
from ratewise.session import scratch_path

#: Words of one row can take each other's place.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indian"),
    ("immigrants", "refugees", "foreigners", "natives", "locals"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("ausländer", "flüchtlinge", "einheimische"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("immigrés", "réfugiés", "étrangers"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
    ("inmigrantes", "refugiados", "extranjeros"),
)
_HASH = WordHash(303)
_LETTERS = re.compile(r"[^\W\d_]+")


def swap_table(groups: Iterable[tuple[str, ...]]) -> dict[str, str]:
    """What takes the place of each term: the next one of its group."""
    return {
        term: terms[(i + 1) % len(terms)] for terms in groups for i, term in enumerate(terms)
    }


@dataclass(frozen=True)
class Training:
    """Bounds and strengths of the fit."""

    max_rows: int = 12_000  # labelled rows it is fitted on, the first by hash of their id
    bits: int = 20  # 2 ** bits weights
    beginnings: tuple[int, ...] = (4, 5, 6)  # bytes of a word's start that are features
    min_texts: int = 3  # labelled texts a feature must be in
    min_evidence: float = 12.0  # its log-likelihood ratio (G squared) against the labels
    epochs: int = 12
    batch: int = 256
    rate: float = 0.5
    shrink: float = 1e-4
    swap_penalty: float = 0.1
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS  # words that can be swapped
    found_terms: int = 64  # at most as many are found in the labelled rows besides


def features(texts: list[bytes], bits: int, beginnings: tuple[int, ...]):
    """(text, feature) of the distinct features of each text, sorted."""
    words = split_words([t.lower() for t in texts])
    owner = words.text_of_word()
    found = [(owner, words.hashes(_HASH))]
    for size in beginnings:
        long = words.length > size
        inside = np.repeat(long, words.length) & (words.at < size)
        length = np.full(int(long.sum()), size, np.int64)
        h = _HASH.of(words.data[inside], words.at[inside], np.cumsum(length) - length, length)
        found.append((owner[long], h ^ np.uint64(size)))
    text = np.concatenate([t for t, _ in found]).astype(np.uint64)
    h = np.concatenate([h for _, h in found]) * np.uint64(0x9E3779B97F4A7C15)
    both = np.unique(text << np.uint64(bits) | h >> np.uint64(64 - bits))
    return (both >> np.uint64(bits)).astype(np.int64), (
        both & np.uint64((1 << bits) - 1)
    ).astype(np.int64)


def swap_terms(text: str, table: dict[str, str]) -> str | None:
    """The text with each of its group terms swapped; None if it names none."""
    swapped = _LETTERS.sub(lambda m: table.get(m[0].lower(), m[0]), text)
    return swapped if swapped != text else None


def swaps(
    texts: list[bytes], rows: list[np.ndarray], table: dict[str, str], options: Training
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features that go and that come when the group terms of each text are swapped.

    ``rows`` are the features of the texts. What another word of the text gives
    as well neither goes nor comes.
    """
    none = np.empty(0, np.int64)
    out = [(none, none)] * len(texts)
    swapped = [swap_terms(t.decode(), table) for t in texts]
    named = [i for i, t in enumerate(swapped) if t is not None]
    if named:
        owner, found = features([swapped[i].encode() for i in named], options.bits, options.beginnings)
        new = np.split(found, np.searchsorted(owner, np.arange(1, len(named))))
        for i, f in zip(named, new):
            out[i] = np.setdiff1d(rows[i], f), np.setdiff1d(f, rows[i])
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def evidence(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Log-likelihood ratio of each feature: does having it say something on the label?"""
    every = np.concatenate(rows)
    toxic = np.concatenate([r for r, y in zip(rows, labels) if y] or [every[:0]])
    with_, toxic_with = np.bincount(every, minlength=size), np.bincount(toxic, minlength=size)
    n, positive = len(rows), labels.sum()
    total = np.zeros(size)
    for here, among in (
        (toxic_with, with_),
        (positive - toxic_with, n - with_),
    ):
        for share, part in ((positive / n, here), (1 - positive / n, among - here)):
            expected = among * share
            ratio = np.divide(part, expected, out=np.ones(size), where=(expected > 0) & (part > 0))
            total += 2 * part * np.log(ratio)
    return total


def _fit(labels: np.ndarray, rows: list[np.ndarray], swapped: list, options: Training):
    """Weights (the last is the bias) by AdaGrad over batches of texts."""
    size = 1 << options.bits
    seen = np.bincount(np.concatenate(rows), minlength=size)
    usable = (seen >= options.min_texts) & (evidence(rows, labels, size) >= options.min_evidence)
    rows = [r[usable[r]] for r in rows]
    weights, squares = np.zeros(size + 1), np.full(size + 1, 1e-6)
    weights[size] = np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    order = np.random.default_rng(7)
    for _ in range(options.epochs):
        shuffled = order.permutation(len(labels))
        for start in range(0, len(shuffled), options.batch):
            batch = shuffled[start : start + options.batch]
            lengths = np.array([len(rows[i]) for i in batch])
            index = np.concatenate([rows[i] for i in batch])
            owner = np.repeat(np.arange(len(batch)), lengths)
            z = np.bincount(owner, weights[index], len(batch)) + weights[size]
            error = _sigmoid(z) - labels[batch]
            gradient = np.bincount(index, error[owner], size + 1).astype(float)
            gradient[size] = error.sum()
            for i in batch:  # the swapped text should score like the text
                gone, came = swapped[i]
                if len(gone):
                    change = weights[came].sum() - weights[gone].sum()
                    gradient[came] += options.swap_penalty * change
                    gradient[gone] -= options.swap_penalty * change
            gradient /= len(batch)
            gradient[:size] += options.shrink * weights[:size]
            touched = gradient != 0
            squares[touched] += gradient[touched] ** 2
            weights[touched] -= options.rate * gradient[touched] / np.sqrt(squares[touched])
            weights[:size][~usable] = 0
    return weights


def find_terms(texts: DataFrame, options: Training = Training()) -> tuple[tuple[str, ...], ...]:
    """Groups of terms of the labelled ``texts`` (toxic, text): words that a fit would lean on.

    A term is a word in at least ``min_texts`` texts that toxic ones have more
    often, with a log-likelihood ratio of ``min_evidence`` or more, though at least half
    of the texts with it are harmless: its mention alone doesn't make a text toxic. The
    ``found_terms`` with the highest ratio count (ties: the smaller word first);
    in the order of how many texts have them, two in a row are a group. A word of
    ``groups`` stays in its own. None are found without both labels.
    """
    n, positive = texts.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not options.found_terms or not 0 < positive < n:
        return ()
    known = [t for terms in options.groups for t in terms]
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)")))
    held = (
        texts.select("toxic", F.explode(words).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
        .filter((F.col("n") >= options.min_texts) & (F.col("toxic") * 2 <= F.col("n")))
        .filter(F.col("toxic") * n > positive * F.col("n"))
        .filter(~F.col("term").isin(known))
    )

    def part(seen, expected):
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    share, ratio = positive / n, F.lit(0.0)
    for among, toxic in (
        (F.col("n"), F.col("toxic")),
        (n - F.col("n"), positive - F.col("toxic")),
    ):
        ratio += part(toxic, among * share) + part(among - toxic, among * (1 - share))
    best = (
        held.withColumn("ratio", ratio)
        .filter(F.col("ratio") >= options.min_evidence)
        .orderBy(F.desc("ratio"), "term")
        .limit(options.found_terms)
        .collect()
    )
    terms = [r.term for r in sorted(best, key=lambda r: (r.n, r.term))]
    if len(terms) < 2:
        return ()
    pairs = [tuple(terms[i : i + 2]) for i in range(0, len(terms) - 1, 2)]
    if len(terms) % 2:
        pairs[-1] += (terms[-1],)
    return tuple(pairs)


def train(docs: DataFrame, labels: DataFrame, options: Training = Training()) -> np.ndarray:
    """Weights fitted on labelled rows (doc_id, toxic) of ``docs``.

    At most ``max_rows`` of them, those with the smallest hash of the id. Rows
    without id or label are left out; an id that is labelled twice counts as
    toxic if either is; of several texts with one id the smallest counts.
    Without any labelled text nothing is toxic.
    """
    spark = docs.sparkSession
    bits, beginnings = options.bits, options.beginnings
    chosen = (
        labels.select("doc_id", "toxic")
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(options.max_rows)
    )
    texts = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
    )
    path = scratch_path(spark, "labelled-texts")
    texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic", "text").write.parquet(path)
    texts = spark.read.parquet(path)
    table = swap_table((*options.groups, *find_terms(texts, options)))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = text_bytes(batch.column("text"))
            rows, gone, came = [], [], []
            for a, b in groups_of(bodies):
                owner, found = features(bodies[a:b], bits, beginnings)
                rows += np.split(found, np.searchsorted(owner, np.arange(1, b - a)))
                for g, c in swaps(bodies[a:b], rows[a:b], table, options):
                    gone.append(g)
                    came.append(c)
            lists = [pa.array([list(x) for x in y], pa.list_(pa.int32())) for y in (rows, gone, came)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), *lists],
                ["doc_id", "toxic", "found", "gone", "came"],
            )

    path = scratch_path(spark, "labelled-features")
    texts.mapInArrow(
        extract,
        "doc_id bigint, toxic int, found array<int>, gone array<int>, came array<int>",
    ).write.parquet(path)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, marks, rows, swapped = [], [], [], []
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            marks += batch.column("toxic").to_pylist()
            rows += [np.asarray(x.values, np.int32) for x in batch.column("found")]
            swapped += [
                (np.asarray(g.values, np.int32), np.asarray(c.values, np.int32))
                for g, c in zip(batch.column("gone"), batch.column("came"))
            ]
        if not ids:
            return
        order = np.argsort(ids)
        weights = _fit(
            np.array(marks, float)[order], [rows[i] for i in order], [swapped[i] for i in order],
            options,
        )
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], ["at", "weight"])

    # The sample is bounded, so one task may hold it.
    fitted = spark.read.parquet(path).coalesce(1).mapInArrow(fit, "at bigint, weight double")
    found = fitted.toPandas()
    weights = np.zeros((1 << bits) + 1)
    if not len(found):
        weights[-1] = -40.0
    weights[found["at"].to_numpy(int)] = found["weight"].to_numpy(float)
    return weights


def score(
    docs: DataFrame, weights: np.ndarray, options: Training = Training(), name: str = "toxicity"
) -> DataFrame:
    """All columns of ``docs`` and its toxicity from 0 to 1, of the whole text.

    Null and empty texts have no features and get the bias alone. The score is
    the column ``name``, which takes the place of one that is called so already.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    bits, beginnings = options.bits, options.beginnings

    @F.pandas_udf("double")
    def toxicity(texts):
        w = shared.value
        bodies = [t.encode() if t is not None else b"" for t in texts]
        out = np.zeros(len(bodies))
        for a, b in groups_of(bodies):
            owner, found = features(bodies[a:b], bits, beginnings)
            out[a:b] = _sigmoid(np.bincount(owner, w[found], b - a) + w[-1])
        return texts.__class__(out, index=texts.index)

    return docs.withColumn(name, toxicity(F.col("text")))


def reject(docs: DataFrame, labels: DataFrame, options: Training = Training()) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with their columns, whatever their names."""
    name = free_prefix(docs.columns) + "toxicity"
    scored = score(docs, train(docs, labels, options), options, name)
    return scored.filter(F.col(name) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
