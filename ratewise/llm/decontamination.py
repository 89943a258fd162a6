"""Benchmark passages in documents, found by winnowed fingerprints.

All of it is built-in functions. A window is 13 consecutive words. Its
fingerprint is the smallest hash of the eight 6-word runs in it, so two equal
windows have equal fingerprints, and neighbours mostly share theirs. Only
windows whose fingerprint the benchmark has, too, are written out and joined;
the join extends the fingerprint to all words of the window. An item of fewer
words is one window, and its fingerprint the hash of all its words.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.text import let, lower_ascii
from ratewise.session import scratch_path

WINDOW, RUN = 13, 6
# Fixed value: what parts the words of lower-cased texts.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bits of the filter over the benchmark's fingerprints: 128 kB, whatever its size.
FILTER_BITS = 1 << 20


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _hashes(words: Column, n: int) -> Column:
    """Hash of each run of n words."""
    return F.when(
        F.size(words) >= n,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (n - 1)),
            lambda i: F.xxhash64(F.slice(words, i, F.lit(n))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _minima(hashes: Column, n: int) -> Column:
    """Smallest of each n consecutive hashes: the fingerprints of the windows."""
    return F.when(
        F.size(hashes) >= n,
        F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (n - 1)),
            lambda i: F.array_min(F.slice(hashes, i, F.lit(n))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def windows(words: Column, length: int, wanted=lambda fingerprint: F.lit(True)) -> Column:
    """Array of (start, length, fp, words) of the windows with a ``wanted`` fingerprint.

    Starts count from 0; the words are joined by blanks, which no word holds.
    """

    def of(w: Column) -> Column:
        if length < WINDOW:
            fps = _hashes(w, length)
        else:
            fps = let(_hashes(w, RUN), lambda h: _minima(h, WINDOW - RUN + 1))
        placed = F.transform(fps, lambda fp, i: F.struct(i.alias("start"), fp.alias("fp")))
        return F.transform(
            F.filter(placed, lambda p: wanted(p["fp"])),
            lambda p: F.struct(
                p["start"].alias("start"),
                F.lit(length).alias("length"),
                p["fp"].alias("fp"),
                F.array_join(F.slice(w, p["start"] + 1, F.lit(length)), " ").alias("words"),
            ),
        )

    return let(words, of)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(length, fp, words, items) of the distinct windows; items without id or words have none."""
    size = F.size("words")
    rows = benchmark.filter("item_id is not null").select(
        F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text")).alias("words")
    )
    found = windows(F.col("words"), WINDOW)
    whole = F.array(
        F.struct(
            F.lit(0).alias("start"),
            size.alias("length"),
            F.xxhash64("words").alias("fp"),
            F.array_join("words", " ").alias("words"),
        )
    )
    found = F.when(size >= WINDOW, found).when(size > 0, whole)
    each = rows.select("item_id", F.explode(found).alias("w")).select("item_id", "w.*")
    return each.groupBy("length", "fp", "words").agg(
        F.sort_array(F.collect_set("item_id")).alias("items")
    )


def _bits(fp: Column, n: int) -> list[Column]:
    """Two places of a fingerprint among n bits."""
    return [F.pmod(F.shiftright(fp, s), F.lit(n)).cast("int") for s in (0, 33)]


def fingerprint_filter(fps: DataFrame, bits: int = FILTER_BITS):
    """Test whether a fingerprint may be in ``fps`` (fp), by a bit map of fixed size.

    False for a fingerprint only if it is absent. The map has ``bits`` / 64 rows
    at most, however many fingerprints there are.
    """
    places = fps.select(F.explode(F.array(*_bits(F.col("fp"), bits))).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit") % 64)
    parts = places.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("part")).agg(
        F.bit_or(one).alias("value")
    )
    values = [0] * (bits // 64)
    for part, value in parts.toLocalIterator():
        values[part] = value
    table = F.from_json(F.lit(json.dumps(values)), "array<bigint>")

    def test(fp: Column) -> Column:
        first, second = (
            F.getbit(F.get(table, F.floor(b / 64).cast("int")), b % 64) == 1
            for b in _bits(fp, bits)
        )
        return first & second

    return test


def _covered(intervals: Column) -> Column:
    """Words inside a set of (start, length), each counted once."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total"))

    def add(acc: Column, x: Column) -> Column:
        end = x["start"] + x["length"]
        fresh = F.greatest(F.lit(0), end - F.greatest(acc["end"], x["start"]))
        return F.struct(
            F.greatest(acc["end"], end).alias("end"),
            (acc["total"] + fresh.cast("bigint")).alias("total"),
        )

    return F.aggregate(F.sort_array(intervals), start, add, lambda acc: acc["total"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): its benchmark words and items.

    Columns: doc_id, text_hash (of the text, to tell apart rows that share an
    id), n_words, n_hit, items (sorted ids as strings), contaminated (at least
    one hit word in twenty). Defined results: null and empty texts have no words
    and aren't contaminated; repeated rows each get their row; items without
    words, or without an id, hit nothing; equal windows of many items are one
    row of the join, and a document meets each set of items once, so a passage
    that many items share doesn't multiply.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "benchmark-windows")
    benchmark_windows(benchmark).withColumn(
        "items_key", F.sha2(F.array_join("items", ","), 256)
    ).write.parquet(path)
    known = spark.read.parquet(path)
    wanted = fingerprint_filter(known.select("fp"))
    lengths = [r[0] for r in known.select("length").distinct().collect()]  # 13 at most

    def candidates(words: Column) -> Column:
        if not lengths:
            empty = "array<struct<start:int,length:int,fp:bigint,words:string>>"
            return F.array().cast(empty)
        return let(words, lambda w: F.concat(*[windows(w, n, wanted) for n in lengths]))

    text_words = item_words(F.col("text"))
    path = scratch_path(spark, "candidate-windows")
    docs.select(
        F.col("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        let(
            text_words,
            lambda w: F.struct(F.size(w).cast("bigint").alias("n"), candidates(w).alias("found")),
        ).alias("x"),
    ).select("doc_id", "text_hash", "x.*").write.parquet(path)
    scanned = spark.read.parquet(path)

    key = ["doc_id", "text_hash"]
    spans = scanned.select(*key, F.explode("found").alias("w")).select(*key, "w.*")
    hits = spans.join(known.select("fp", "words", "items_key"), ["fp", "words"]).select(
        *key, "start", "length", "items_key"
    )
    path = scratch_path(spark, "benchmark-hits")
    hits.write.parquet(path)
    hits = spark.read.parquet(path)
    covered = hits.groupBy(*key).agg(
        _covered(F.collect_set(F.struct("start", "length"))).alias("n_hit")
    )
    sets = known.groupBy("items_key").agg(F.first("items").alias("items"))
    items = (
        hits.select(*key, "items_key")
        .distinct()
        .join(sets, "items_key")
        .select(*key, F.explode("items").alias("item"))
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = covered.join(items, [covered[c].eqNullSafe(items[c]) for c in key]).select(
        covered["doc_id"].alias("hit_id"), covered["text_hash"].alias("hit_hash"), "n_hit", "items"
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    rows = scanned.select(*key, F.col("n").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return rows.join(found, same, "left").select(
        *key,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with all their columns."""
    bad = (
        contamination(docs.select("doc_id", "text"), benchmark)
        .filter("contaminated")
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct()
    )
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
