"""SimHash near-duplicates, searched by keys of the binary Golay code.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. Where two
fingerprints differ in at most two bits, one of the segments is equal in both.
The next segment (cyclically) then differs in two bits at most; filled up to 23
bits it is decoded to the Golay codewords at distance 4 or less (one or six of
them). Two such words within two bits of each other always share one: let c be
the codeword nearest to the first, at distance a <= 3 (the code is perfect). For
a <= 2 the second is within 4 of c. For a = 3 take the five codewords that agree
with the first in its three errors and lie at distance 4: their four further
places part the other twenty, so one of them holds a place where both words
differ, and it is within 4 of the second, too. Hence equal segment + codeword
index (21 + 12 bits) are keys under which every such pair meets, at most 18 a
fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.components import components
from ratewise.llm.text import free_prefix, groups_of, text_bytes
from ratewise.session import scratch_path

# Generator polynomial of the Golay code, segment widths.
_GENERATOR = 0b101011100011
_WIDTHS = (22, 21, 21)
_NEAR = 4


@cache
def golay_codewords() -> np.ndarray:
    """The 4,096 words of 23 bits, by message: products with the generator over GF(2)."""
    message = np.arange(4096, dtype=np.uint32)
    word = np.zeros(4096, np.uint32)
    for bit in range(12):
        if _GENERATOR >> bit & 1:
            word ^= message << np.uint32(bit)
    return word


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder after division by the generator, 11 bits; zero for codewords."""
    rest = words.astype(np.uint32)
    for bit in range(22, 10, -1):
        rest = rest ^ np.where(
            rest >> np.uint32(bit) & np.uint32(1), np.uint32(_GENERATOR << (bit - 11)), np.uint32(0)
        )
    return rest


@cache
def _errors_by_syndrome() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error patterns of weight 4 or less, padded, and their number."""
    codewords = golay_codewords()
    weights = np.bitwise_count(codewords)
    bits = np.uint32(1) << np.arange(23, dtype=np.uint32)
    leaders = [np.zeros(1, np.uint32)]
    for _ in range(3):  # all patterns of one bit more
        grown = (leaders[-1][:, None] | bits[None, :]).ravel()
        grown = np.unique(grown[np.bitwise_count(grown) == len(leaders)])
        leaders.append(grown)
    leader = np.concatenate(leaders)
    by = np.empty(2048, np.uint32)
    by[_syndrome(leader)] = leader
    near = codewords[weights <= _NEAR + 3]
    errors = np.zeros((2048, 6), np.uint32)
    count = np.zeros(2048, np.int64)
    for word in near:  # all words of one syndrome are its leader plus a codeword
        shifted = by ^ word
        fits = np.flatnonzero(np.bitwise_count(shifted) <= _NEAR)
        errors[fits, count[fits]] = shifted[fits]
        count[fits] += 1
    return errors, count


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codewords (n x 6) within distance 4 of 23-bit words, and which of them count."""
    errors, count = _errors_by_syndrome()
    syndrome = _syndrome(words)
    keys = words.astype(np.uint32)[:, None] ^ errors[syndrome]
    return keys, np.arange(6)[None, :] < count[syndrome][:, None]


def segment_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the fingerprints: segment number, equal segment, codeword of the next."""
    shifts = np.cumsum((0, *_WIDTHS[:-1]))
    parts = [
        fingerprints >> np.uint64(s) & np.uint64((1 << w) - 1) for s, w in zip(shifts, _WIDTHS)
    ]
    rows, keys = [], []
    for i in range(3):
        codewords, counts = golay_keys(parts[(i + 1) % 3].astype(np.uint32))
        key = np.uint64(i) << np.uint64(46) | parts[i][:, None] << np.uint64(23)
        key = key | codewords.astype(np.uint64)
        row, _ = np.nonzero(counts)
        rows.append(row)
        keys.append(key[counts])
    return np.concatenate(rows), np.concatenate(keys).astype(np.int64)


def shingles(text: bytes, size: int) -> list[bytes]:
    """Runs of ``size`` words joined by blanks; the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= size:
        return [b" ".join(words)]
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[: -size]]
    return [whole[a : b - 1] for a, b in zip(starts, ends[size - 1 :])]


def fingerprint(parts: list[bytes], step: int = 8192) -> int:
    """Bits set in more than half of the XXH64 values (seed 42) of the shingles."""
    if not parts:
        return 0
    total = np.zeros(64, np.int64)
    of = xxhash.xxh64_intdigest
    for i in range(0, len(parts), step):
        h = np.array([of(p, 42) for p in parts[i : i + step]], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    ones = np.flatnonzero(2 * total > len(parts)).tolist()
    return sum(1 << i for i in ones)


def fingerprints(docs: DataFrame, words: int = 3, hashed: bool = False) -> DataFrame:
    """(doc_id, fp) for each document; texts without words, null ones too, have fp 0.

    With ``hashed`` also text_hash, which tells rows of one doc_id apart.
    """
    names = ["doc_id", "text_hash"] if hashed else ["doc_id"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            fps = [fingerprint(shingles(t, words)) for t in texts]
            signed = pa.array(np.array(fps, np.uint64).view(np.int64))
            own = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*own, signed], [*names, "fp"])

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")
    )
    schema = ", ".join(f"{n} bigint" for n in [*names, "fp"])
    return rows.select(*names, "text").mapInArrow(compute, schema)


def _flips(fp: str):
    """The fingerprint and its 64 neighbours at one bit."""
    value = F.col(fp)
    flipped = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)),
    )
    return F.concat(F.array(value), flipped)


def links(distinct: DataFrame, max_bits: int = 2, small_bucket: int = 32) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` within ``max_bits`` (1 or 2) of each other.

    Fingerprints that share a Golay key form a bucket. Pairs of buckets of up to
    ``small_bucket`` are verified one by one. A larger bucket isn't paired: each
    of its fingerprints is hung on the 65 values within one bit of it, and those
    that meet at such a value are within two bits of each other. This way is
    exact, and its rows grow with the fingerprints, not with their square.
    """
    if max_bits not in (1, 2):
        raise ValueError("the Golay keys hold for 1 or 2 differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            row, key = segment_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(fps[row]), pa.array(key)], ["fp", "key"])

    spark = distinct.sparkSession
    keys = distinct.select("fp").mapInArrow(keyed, "fp bigint, key bigint")
    path = scratch_path(spark, "golay-keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    keys.join(sizes, "key").write.parquet(path)
    shared = spark.read.parquet(path)

    few = shared.filter(F.col("size") <= small_bucket).select("key", "fp")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (
        few.withColumnRenamed("fp", "a")
        .join(few.withColumnRenamed("fp", "b"), "key")
        .filter(F.col("a") < F.col("b"))
        .filter(near <= max_bits)
        .select("a", "b")
    )
    many = shared.filter(F.col("size") > small_bucket).select("fp").distinct()
    spots = many.select("fp", F.explode(_flips("fp")).alias("spot"))
    if max_bits == 1:  # two values one bit apart: the lower one, with the place of the bit
        spots = spots.filter("spot <> fp").select("fp", F.struct(
            F.least("fp", "spot").alias("low"), F.greatest("fp", "spot").alias("high")
        ).alias("spot"))
    least = spots.groupBy("spot").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
    hung = (
        spots.join(least.filter("n > 1"), "spot")
        .filter("fp <> a")
        .select("a", F.col("fp").alias("b"))
    )
    return pairs.union(hung).distinct()


def _classes(
    docs: DataFrame, words: int, max_bits: int, small_bucket: int = 32, hashed: bool = False
) -> DataFrame:
    """Rows of ``fingerprints`` with root, the fingerprint of their class, and its component_id."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs, words, hashed).write.parquet(path)
    marked = spark.read.parquet(path)
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    path = scratch_path(spark, "distinct-fingerprints")
    nodes.write.parquet(path)
    nodes = spark.read.parquet(path)

    roots = components(links(nodes, max_bits, small_bucket))
    classed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    names = classed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = classed.join(names, "root").select("fp", "root", "component_id")
    return marked.join(of_fp, "fp")


def near_duplicates(
    docs: DataFrame, words: int = 3, max_bits: int = 2, small_bucket: int = 32
) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs`` (doc_id, text).

    Copies share a fingerprint and are one node of the search. The class of a
    document is the smallest doc_id that links reach. Defined results: null and
    empty texts have fingerprint 0 and link like others; repeated rows stay
    repeated; a null doc_id is kept and never names a class unless the whole
    class has none; an empty table gives an empty result.
    """
    return _classes(docs, words, max_bits, small_bucket).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one with the smallest doc_id.

    A class is told by its fingerprint, so classes without any doc_id, or of
    different texts under one doc_id, keep a row each. Rows of a class that
    repeat its doc_id, or that all have none, are told apart by their whole
    content, of which the smallest stays.
    """
    spark = docs.sparkSession
    names = docs.columns
    own = free_prefix(names)
    id_, hash_, root, n, least = (f"{own}{c}" for c in ("id", "hash", "root", "n", "least"))
    picked = (
        _classes(docs, words, max_bits, hashed=True)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id", "text_hash")
        .agg(F.count("*").alias("n"))
    )
    sizes = picked.groupBy("root").agg(F.sum("n").alias(n))
    path = scratch_path(spark, "chosen")
    picked.drop("n").join(sizes, "root").withColumnsRenamed(
        {"doc_id": id_, "text_hash": hash_, "root": root}
    ).write.parquet(path)
    chosen = spark.read.parquet(path)
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col(id_)) & (
        F.xxhash64(docs["text"]) == F.col(hash_)
    )
    single = docs.join(chosen.filter(F.col(n) == 1), same, "left_semi")
    rank = F.struct(*[F.col(f"`{c}`") for c in sorted(names)])
    first = docs.join(chosen.filter(F.col(n) > 1), same).groupBy(root).agg(F.min(rank).alias(least))
    return single.unionByName(
        first.select(*[F.col(least).getField(c).alias(c) for c in names])
    )
