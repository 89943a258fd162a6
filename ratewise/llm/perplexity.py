"""Quality rules on whole texts, with perplexity bands by language.

A symbol of the n-gram model is a code point, nothing is folded: small letters of a to z,
the blank, the line end and four marks are the first 32 symbols, and every other
character is one of its own. Spark counts the 4-grams of every text by language; the modified
Kneser-Ney model of a language (three discounts an order, continuation counts
below the highest) is kept as sorted arrays of n-gram hashes with their
probability, and of context hashes with their back-off weight. Of the first 32 symbols
a language has 32 ** 4 n-grams at most, so these arrays have a bound that doesn't grow
with the documents, while their counts cover all of them. N-grams with another symbol have
no such bound: the models of languages that have any are computed by joins and aggregates.
The most frequent of these n-grams, a bounded number, are in sorted arrays too; the others
of a text are joined to their probabilities.

A second model of each language sees classes of characters (a letter without case and
accent, any digit, any end of sentence, any other mark and so on, 32 in all): marks that
code points tell apart add up there. A text must lie within the bands of both. Every language
has its models; texts are scored language by language in waves whose arrays have a bounded
size together, so the number of languages isn't limited.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.text import WordHash, finish, groups_of, split_words, text_bytes
from ratewise.session import scratch_path

ORDER, SYMBOLS = 4, 32
_BITS = 5
#: The characters that are the first 32 symbols, in order.
_FIRST = " abcdefghijklmnopqrstuvwxyz,.\n-'"
#: Bits of a symbol where all other characters have their own: 32 + the code point.
_OWN_BITS = 21
#: Rows of the models that are broadcast at once (12 bytes each; one language has at most
#: 2.8 million).
WAVE_ROWS = 1 << 21
#: N-grams of a model with a symbol beyond the first 32 that are in its arrays, at most.
OWN_ROWS = 1 << 19
#: N-grams with such a symbol that a task holds while it counts.
OWN_HELD = 1 << 19
#: Languages whose counts a task holds at once, of 8 MB each.
HELD = 8
OTHER = ""  # the model of texts without a language
_HASH = WordHash(404)


@dataclass(frozen=True)
class Band:
    """Accepted log perplexity: median of the language +- widths of its spread.

    The mean of a short text varies more, so widths grow by the root of
    1 + ``short`` / characters.
    """

    below: float = 3.0
    above: float = 3.0
    least_spread: float = 0.01
    short: float = 600.0


@cache
def symbol_of(code: int) -> int:
    """Symbol of a character: one of the first 32, or 32 + its code point."""
    place = _FIRST.find(chr(code))
    return place if place >= 0 else SYMBOLS + code


@cache
def class_of(code: int) -> int:
    """Class of a character, for the second model."""
    char = chr(code)
    base = unicodedata.normalize("NFD", char.lower())[0]
    if "a" <= base <= "z":
        return 1 + ord(base) - ord("a")
    if char.isdigit():
        return 27
    if char in ".!?":
        return 28
    if char in "\n\r":
        return 29
    if char.isspace():
        return 0
    if char.isalpha() or unicodedata.category(char)[0] in "LM":
        return 31
    return 30


@cache
def class_table() -> np.ndarray:
    """Class of each character below U+0250."""
    return np.array([class_of(code) for code in range(0x250)], np.uint32)


@cache
def symbol_table() -> np.ndarray:
    """Symbol of each character below U+0250."""
    return np.array([symbol_of(code) for code in range(0x250)], np.uint32)


@cache
def own_letters() -> str:
    """Pattern that every text with a character beyond the first 32 symbols matches.

    The characters are given as runs, for a class is searched part by part; most texts match
    at one of their first characters.
    """
    own = np.flatnonzero(symbol_table() >= SYMBOLS)
    ascii_, latin = (
        "".join(rf"\x{{{run[0]:X}}}-\x{{{run[-1]:X}}}" for run in np.split(part, np.flatnonzero(np.diff(part) > 1) + 1))
        for part in (own[own < 0x80], own[own >= 0x80])
    )
    return rf"[\x{{80}}-\x{{10FFFF}}&&[{latin}\x{{250}}-\x{{10FFFF}}]]|[{ascii_}]"


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each with line ends before it, and the bounds of the texts."""
    lead = "\n" * (ORDER - 1)
    codes = np.frombuffer("".join(lead + t for t in texts).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t) + len(lead) for t in texts], np.int64)
    return codes, np.concatenate([[0], np.cumsum(sizes)])


def symbols(codes: np.ndarray) -> np.ndarray:
    """Symbol of each code point."""
    table = symbol_table()
    low = table[np.minimum(codes, len(table) - 1)]
    return np.where(codes < len(table), low, codes + np.uint32(SYMBOLS))


def classes(codes: np.ndarray) -> np.ndarray:
    """Class of each code point."""
    table = class_table()
    found = table[np.minimum(codes, len(table) - 1)]
    beyond = np.flatnonzero(codes >= len(table))
    if len(beyond):
        which, kinds = pd.factorize(codes[beyond])
        found[beyond] = np.array([class_of(int(c)) for c in kinds], np.uint32)[which]
    return found


def _windows(
    texts: list[str], of: Callable[[np.ndarray], np.ndarray] = symbols
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, the bounds of the texts, whether a 4-gram begins at a symbol that stays in
    its text, and whether that has a symbol beyond the first 32."""
    codes, bounds = _codes(texts)
    found = of(codes)
    n = max(len(found) - ORDER + 1, 0)
    # The 4-grams that begin at the last characters of a text cross into the next.
    inside = np.ones(n, bool)
    for k in range(1, ORDER):
        past = bounds[1:-1] - k
        inside[past[(past >= 0) & (past < n)]] = False
    own = np.zeros(n, bool)
    letters = found >= SYMBOLS
    if letters.any():
        for k in range(ORDER):
            own |= letters[k : k + n]
    return found, bounds, inside, own


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram of the first 32 symbols that ends at each character of the texts, if it has
    no other, and the bounds of the texts."""
    return _first_grams(*_windows(texts))


def _first_grams(
    found: np.ndarray, bounds: np.ndarray, inside: np.ndarray, own: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    n = len(inside)
    key = np.zeros(n, np.uint32)
    for k in range(ORDER):
        key = key << np.uint32(_BITS) | found[k : k + n]
    held = inside & ~own
    return key[held], np.concatenate([[0], np.cumsum(held)])[np.minimum(bounds, n)]


def own_hash(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Hash of 4-grams with a symbol beyond the first 32."""
    return finish(finish(context.astype(np.uint64)) + symbol.astype(np.uint64))


class OwnGrams:
    """The 4-grams of texts with a symbol beyond the first 32: ``text`` and ``which`` by
    place, and of each distinct one its hash, its last symbol and the context of the three
    before."""

    def __init__(self, found: np.ndarray, bounds: np.ndarray, inside: np.ndarray, own: np.ndarray):
        at = np.flatnonzero(inside & own)
        self.text = np.searchsorted(bounds, at, "right") - 1
        context = np.zeros(len(at), np.int64)
        for k in range(ORDER - 1):
            context = context << _OWN_BITS | found[at + k].astype(np.int64)
        symbol = found[at + ORDER - 1].astype(np.int64)
        self.which, self.hash = pd.factorize(own_hash(context, symbol))
        place = np.empty(len(self.hash), np.int64)
        place[self.which] = np.arange(len(at))
        self.context, self.symbol = context[place], symbol[place]

    def of_texts(self, lost: np.ndarray) -> pd.DataFrame:
        """(text, which, n) of those that ``lost`` says, by distinct one."""
        at = np.flatnonzero(lost[self.which])
        rows = pd.DataFrame({"text": self.text[at], "which": self.which[at]})
        return rows.groupby(["text", "which"]).size().reset_index(name="n")


def _texts(column) -> list[str]:
    return [t if t is not None else "" for t in column.to_pylist()]


_COUNTS = ["model", "classes", "gram", "context", "symbol", "n"]


def count_grams(docs: DataFrame) -> DataFrame:
    """(model, classes, gram, context, symbol, n): 4-grams of all texts (model, text), added
    up by model. Those of the first 32 symbols and of classes have a gram, the others a
    context and a symbol."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}  # two rows: of symbols and of classes
        beyond: dict[str, list[np.ndarray]] = {}  # rows of hash, context, symbol, n
        size = characters = 0

        def rows(model: str, of_classes: bool, gram, context, symbol, n) -> pa.RecordBatch:
            none = pa.nulls(len(n), pa.int64())
            columns = [none if x is None else pa.array(x, pa.int64()) for x in (gram, context, symbol, n)]
            named = [pa.array([model] * len(n), pa.string()), pa.array([of_classes] * len(n), pa.bool_())]
            return pa.RecordBatch.from_arrays(named + columns, _COUNTS)

        def given() -> Iterator[pa.RecordBatch]:
            for model, both in held.items():
                for of_classes, n in enumerate(both):
                    gram = np.flatnonzero(n)
                    yield rows(model, bool(of_classes), gram, None, None, n[gram])
            held.clear()

        def merged(found: list[np.ndarray]) -> np.ndarray:
            every = np.concatenate(found, axis=1)
            which, hashes = pd.factorize(every[0])
            out = np.empty((4, len(hashes)), np.int64)
            out[:, which] = every
            # Sums below 2 ** 53 are exact in the floats that add them up.
            out[3] = np.bincount(which, every[3], len(hashes)).astype(np.int64)
            return out

        def given_beyond() -> Iterator[pa.RecordBatch]:
            for model, found in beyond.items():
                _, context, symbol, n = merged(found)
                yield rows(model, False, None, context, symbol, n)
            beyond.clear()

        for batch in batches:
            texts = _texts(batch.column("text"))
            models = np.array(batch.column("model").to_pylist(), object)
            for model in dict.fromkeys(models):
                own = [texts[i] for i in np.flatnonzero(models == model)]
                if model not in held:
                    if len(held) == HELD:
                        yield from given()
                    held[model] = np.zeros((2, SYMBOLS**ORDER), np.uint32)
                for a, b in groups_of(own):
                    windows = _windows(own[a:b])
                    of_classes = _first_grams(*_windows(own[a:b], classes))[0]
                    characters += len(of_classes)
                    if characters >> 32:  # more than a count holds
                        yield from given()
                        held[model] = np.zeros((2, SYMBOLS**ORDER), np.uint32)
                        characters = len(of_classes)
                    for n, gram in zip(held[model], (_first_grams(*windows)[0], of_classes), strict=True):
                        n += np.bincount(gram, minlength=SYMBOLS**ORDER).astype(np.uint32)
                    new = OwnGrams(*windows)
                    if not len(new.hash):
                        continue
                    n = np.bincount(new.which, minlength=len(new.hash))
                    part = np.stack([new.hash.view(np.int64), new.context, new.symbol, n])
                    beyond.setdefault(model, []).append(part)
                    size += len(n)
                    if size > OWN_HELD:
                        beyond = {m: [merged(found)] for m, found in beyond.items()}
                        size = sum(found[0].shape[1] for found in beyond.values())
                        if size > OWN_HELD // 2:
                            yield from given_beyond()
                            size = 0
        yield from given()
        yield from given_beyond()

    schema = "model string, classes boolean, gram bigint, context bigint, symbol bigint, n bigint"
    return docs.mapInArrow(count, schema).groupBy(*_COUNTS[:-1]).agg(F.sum("n").alias("n"))


def _discounts(n: np.ndarray) -> np.ndarray:
    """Discount of each count, from how many n-grams were seen once to four times."""
    seen = np.bincount(np.minimum(n, 5), minlength=6)[:5].astype(float)
    if not all(seen[1:]):
        flat = np.where(n > 0, 0.5, 0.0)
        return np.minimum(flat, n)
    y = seen[1] / (seen[1] + 2 * seen[2])
    d = [0.0] + [k - (k + 1) * y * seen[k + 1] / seen[k] for k in (1, 2, 3)]
    return np.clip(np.array(d)[np.minimum(n, 3)], 0, n)


def gram_hash(gram: np.ndarray, order: int) -> np.ndarray:
    return finish(gram.astype(np.uint64) | np.uint64(order) << np.uint64(60))


def fit_model(gram: np.ndarray, n: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Interpolated modified Kneser-Ney: (kind, gram, value) by order.

    Kind k holds the log10 probabilities of the k-grams, kind -k the back-off
    weights (log10) of their contexts of k - 1 symbols.
    """
    orders = [(gram, n)]
    for k in range(ORDER - 1, 0, -1):  # how many symbols an n-gram was seen after
        shorter = orders[0][0] & ((1 << _BITS * k) - 1)
        orders.insert(0, tuple(np.unique(shorter, return_counts=True)))
    lower = np.full(SYMBOLS, 1 / SYMBOLS)  # probabilities of all grams one order below
    out = []
    for k, (g, c) in enumerate(orders, 1):
        context = g >> _BITS
        total = np.bincount(context, c, SYMBOLS ** (k - 1))
        cut = _discounts(c)
        free = np.bincount(context, cut, SYMBOLS ** (k - 1))
        seen = total > 0
        backoff = np.divide(free, total, out=np.ones_like(total), where=seen)
        full = lower if k == 1 else np.tile(lower, SYMBOLS)
        full = full * np.repeat(backoff, SYMBOLS)
        full[g] += (c - cut) / total[context]
        out.append((k, g, np.log10(full[g])))
        held = np.flatnonzero(seen)
        out.append((-k, held, np.log10(np.maximum(backoff[held], 1e-12))))
        lower = full
    return out


def train(counts: DataFrame) -> DataFrame:
    """(model, kind, hash, value): the models of counts (model, gram, n), by sorted hashes."""

    def fit(table: pa.Table) -> pa.Table:
        gram, n = table.column("gram").to_numpy(), table.column("n").to_numpy()
        order = np.argsort(gram)
        parts = []
        for kind, g, value in fit_model(gram[order], n[order]):
            h = gram_hash(g, kind if kind > 0 else 8 - kind)
            place = np.argsort(h)
            parts.append(
                pa.table(
                    {
                        "model": pa.array([table.column("model")[0].as_py()] * len(g), pa.string()),
                        "kind": pa.array(np.full(len(g), kind, np.int32)),
                        "hash": pa.array(h[place].view(np.int64)),
                        "value": pa.array(value[place].astype(np.float32)),
                    }
                )
            )
        return pa.concat_tables(parts)

    # The 4-grams of one model: 32 ** 4 rows at most.
    return counts.groupBy("model").applyInArrow(fit, _ROWS)


_ROWS = "model string, kind int, hash bigint, value float"
_FIELD = (1 << _BITS) - 1
#: Kind of the rows of 4-grams with a symbol beyond the first 32.
OWN = ORDER + 1


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widened(counts: DataFrame) -> DataFrame:
    """Counts (model, gram, n) of the first 32 symbols as (model, context, symbol, n)."""
    parts = [
        F.shiftleft(F.shiftright("gram", _BITS * k).bitwiseAND(_FIELD), _OWN_BITS * (k - 1))
        for k in range(1, ORDER)
    ]
    context = parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2])
    symbol = F.col("gram").bitwiseAND(_FIELD)
    return counts.select("model", context.alias("context"), symbol.alias("symbol"), "n")


def _plain() -> Column:
    """Whether a row (context, symbol) has the first 32 symbols alone."""
    beyond = sum((((1 << _OWN_BITS) - 1) ^ _FIELD) << _OWN_BITS * k for k in range(ORDER - 1))
    return (F.col("symbol") < SYMBOLS) & (F.col("context").bitwiseAND(F.lit(beyond)) == 0)


def narrowed(model: DataFrame) -> DataFrame:
    """The rows (model, context, symbol, value) of 4-grams of the first 32 symbols alone, as
    ``train`` gives them. All texts that are scored are counted, so none of them backs off."""
    gram = F.col("symbol")
    for k in range(1, ORDER):
        part = F.shiftright("context", _OWN_BITS * (k - 1)).bitwiseAND(_FIELD)
        gram = gram.bitwiseOR(F.shiftleft(part, _BITS * k))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = gram_hash(batch.column("gram").to_numpy(), ORDER)
            kind = pa.array(np.full(len(h), ORDER, np.int32))
            value = batch.column("value").cast(pa.float32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("model"), kind, pa.array(h.view(np.int64)), value],
                ["model", "kind", "hash", "value"],
            )

    return model.filter(_plain()).select("model", gram.alias("gram"), "value").mapInArrow(hashed, _ROWS)


def frequent_own(model: DataFrame, most: int | None = None) -> DataFrame:
    """The rows (model, context, symbol, n, value) of a model's most frequent 4-grams with a
    symbol beyond the first 32, ``most`` at most, by hash. Equally frequent ones are all
    there or none is."""
    most = OWN_ROWS if most is None else most
    own = model.filter(~_plain())
    down = Window.partitionBy("model").orderBy(F.desc("n"))
    times = own.groupBy("model", "n").agg(F.count("*").alias("grams"))  # the root of the texts' size
    upto = times.withColumn("upto", F.sum("grams").over(down)).filter(F.col("upto") <= most)
    least = upto.groupBy("model").agg(F.min("n").alias("least"))  # a row a model

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = own_hash(batch.column("context").to_numpy(), batch.column("symbol").to_numpy())
            kind = pa.array(np.full(len(h), OWN, np.int32))
            value = batch.column("value").cast(pa.float32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("model"), kind, pa.array(h.view(np.int64)), value],
                ["model", "kind", "hash", "value"],
            )

    kept = own.join(F.broadcast(least), "model").filter(F.col("n") >= F.col("least"))
    return kept.select("model", "context", "symbol", "value").mapInArrow(hashed, _ROWS)


def own_models(counts: DataFrame) -> DataFrame:
    """(model, context, symbol, n, value): log10 probabilities of all 4-grams (model, context,
    symbol, n), as ``fit_model`` gives them, over any number of symbols."""
    key = ["model", "context", "symbol"]
    # Tables of n-grams have no bound, whatever the size of their files: none is broadcast.

    def suffix(symbols: int) -> Column:
        return F.col("context").bitwiseAND(F.lit((1 << _OWN_BITS * symbols) - 1)).alias("context")

    orders = [_written(counts, "own-order")]
    for k in range(ORDER - 1, 0, -1):  # how many symbols an n-gram was seen after
        shorter = orders[0].select("model", suffix(k - 1), "symbol")
        orders.insert(0, _written(shorter.groupBy(*key).agg(F.count("*").alias("n")), "own-order"))
    n = F.col("n")
    # Every symbol ends an n-gram; the first 32 count whether they occur or not.
    lower = orders[0].groupBy("model").agg(
        (1 / (SYMBOLS + F.count_if(F.col("symbol") >= SYMBOLS))).alias("lower")
    )
    for k, grams_of in enumerate(orders, 1):
        seen = [F.count_if(n == i).cast("double").alias(f"s{i}") for i in range(1, 5)]
        s1, s2, s3, s4 = (F.col(f"s{i}") for i in range(1, 5))
        y = s1 / (s1 + 2 * s2)
        cuts = F.array(1 - 2 * y * s2 / s1, 2 - 3 * y * s3 / s2, 3 - 4 * y * s4 / s3)
        every = F.least(s1, s2, s3, s4) > 0
        cuts_of = grams_of.groupBy("model").agg(*seen).select(  # a row a model
            "model", F.when(every, cuts).otherwise(F.array(*[F.lit(0.5)] * 3)).alias("cuts")
        )
        cut = F.get("cuts", F.least(n, F.lit(3)).cast("int") - 1)
        rows = grams_of.join(F.broadcast(cuts_of), "model").withColumn(
            "cut", F.least(F.greatest(cut, F.lit(0.0)), n.cast("double"))
        ).drop("cuts")
        contexts = rows.groupBy("model", "context").agg(
            F.sum("n").alias("total"), F.sum("cut").alias("free")
        )
        if k == 1:
            found = rows.join(F.broadcast(lower), "model")
        else:
            short = lower.drop("n").withColumnRenamed("context", "short").hint("merge")
            found = rows.withColumn("short", suffix(k - 2)).join(short, ["model", "short", "symbol"])
        p = (n - F.col("cut")) / F.col("total") + F.col("free") / F.col("total") * F.col("lower")
        lower = _written(found.join(contexts.hint("merge"), ["model", "context"]).select(*key, "n", p.alias("lower")), "own-model")
    return lower.select(*key, "n", F.log10("lower").alias("value"))


class Model:
    """One language's sorted arrays."""

    def __init__(self, arrays: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.arrays = arrays

    def find(self, gram: np.ndarray, order: int, kind: int) -> np.ndarray:
        """Values of n-grams, NaN where there is none."""
        return self.held(gram_hash(gram, order), kind)

    def held(self, wanted: np.ndarray, kind: int) -> np.ndarray:
        """Values of hashes, NaN where there is none."""
        h, value = self.arrays.get(kind, (np.empty(0, np.uint64), np.empty(0, np.float32)))
        if not len(h):
            return np.full(len(wanted), np.nan, np.float32)
        at = np.minimum(np.searchsorted(h, wanted), len(h) - 1)
        return np.where(h[at] == wanted, value[at], np.float32(np.nan))

    def log10(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log10 probability of the last symbol of n-grams, backing off where unseen."""
        if order == 0:
            return np.full(len(gram), -np.log10(SYMBOLS), np.float32)
        found = self.find(gram, order, order)
        lost = np.flatnonzero(np.isnan(found))
        if len(lost):
            weight = np.nan_to_num(self.find(gram[lost] >> _BITS, 8 + order, -order))
            shorter = gram[lost] & ((1 << _BITS * (order - 1)) - 1)
            found[lost] = weight + self.log10(shorter, order - 1)
        return found

    def of_texts(self, gram: np.ndarray) -> np.ndarray:
        """Log10 probabilities of the 4-grams of texts: each kind is looked up once."""
        if len(gram) < SYMBOLS**ORDER // 16:
            kinds, which = np.unique(gram, return_inverse=True)
            return self.log10(kinds.astype(np.int64))[which]
        kinds = np.flatnonzero(np.bincount(gram, minlength=SYMBOLS**ORDER))
        value = np.empty(SYMBOLS**ORDER, np.float32)
        value[kinds] = self.log10(kinds)
        return value[gram]


def load(models: DataFrame) -> dict[str, Model]:
    """Models from their rows, of one wave (see the module)."""

    def pack(table: pa.Table) -> pa.Table:
        h = table.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(h)
        row = {"model": table.column("model")[:1], "kind": table.column("kind")[:1]}
        for name, data in (("hash", h), ("value", table.column("value").to_numpy())):
            row[name] = pa.array([data[order].tobytes()], pa.binary())
        return pa.table(row)

    packed = models.select("model", "kind", "hash", "value").groupBy("model", "kind").applyInArrow(
        pack, "model string, kind int, hash binary, value binary"
    )
    out: dict[str, dict] = {}
    for r in packed.collect():  # the bytes of arrays, not rows of them
        arrays = np.frombuffer(r["hash"], np.uint64), np.frombuffer(r["value"], np.float32)
        out.setdefault(r["model"], {})[r["kind"]] = arrays
    return {m: Model(arrays) for m, arrays in out.items()}


def waves(sizes: dict[str, int], limit: int | None = None) -> list[list[str]]:
    """Models, by how many rows they have, in groups of at most ``limit`` rows, or of one."""
    limit = WAVE_ROWS if limit is None else limit
    out, rows = [], 0
    for model in sorted(sizes):
        if not out or rows + sizes[model] > limit:
            out.append([])
            rows = 0
        out[-1].append(model)
        rows += sizes[model]
    return out


def rule_counts(text: bytes, hashes: np.ndarray, window: int = 8) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines and n_repeat_words of a text with these words."""
    bare = text.translate(None, b"\t\n\x0b\x0c\r ")
    marks = len(text) - len(text.translate(None, b"#*$%&|<>"))
    lines = [x for x in text.split(b"\n") if x.strip(b"\t\x0b\x0c\r ")]
    repeated = 0
    if len(hashes) > window:
        runs = _HASH.runs(hashes, window)
        _, which, times = np.unique(runs, return_inverse=True, return_counts=True)
        start = np.flatnonzero(times[which] > 1)
        if len(start):
            edges = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(edges, start, 1)
            np.add.at(edges, start + window, -1)
            repeated = int((np.cumsum(edges) > 0).sum())
    return len(bare.decode()), marks, len(lines) - len(set(lines)), repeated


def _scores(docs: DataFrame, models: dict[str, Model], of_classes: dict[str, Model]) -> DataFrame:
    """Counts of the rules, sum and number of the log10 probabilities in the arrays, the log
    perplexity by classes, and the 4-grams that aren't in the arrays: context, symbol and number."""
    shared = docs.sparkSession.sparkContext.broadcast((models, of_classes))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names += ["log_sum", "n_grams", "class_perplexity", "context", "symbol", "times"]

    @F.pandas_udf(
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, log_sum double, n_grams bigint, class_perplexity double, "
        "context array<bigint>, symbol array<bigint>, times array<bigint>"
    )
    def measure(text: pd.Series, model: pd.Series) -> pd.DataFrame:
        found, of_classes = shared.value
        bodies = [t if t is not None else "" for t in text]
        raw = [t.encode() for t in bodies]
        rows = []
        for a, b in groups_of(raw):
            words = split_words(raw[a:b])
            hashes = words.hashes(_HASH)
            models = model.to_numpy()[a:b]
            total, n, beyond = np.zeros(b - a), np.zeros(b - a, np.int64), {}
            by_class = np.zeros(b - a)
            for m in dict.fromkeys(models):
                mine = np.flatnonzero(models == m)
                own_texts = [bodies[a + i] for i in mine]

                def added(windows, by: dict[str, Model]) -> tuple[np.ndarray, np.ndarray]:
                    key, bounds = _first_grams(*windows)
                    times = np.diff(bounds)
                    of_text = np.repeat(np.arange(len(mine)), times)
                    value = by[m].of_texts(key) if len(key) else np.empty(0)
                    return np.bincount(of_text, value, len(mine)), times

                by_class[mine] = added(_windows(own_texts, classes), of_classes)[0]
                windows = _windows(own_texts)
                total[mine], n[mine] = added(windows, found)
                own = OwnGrams(*windows)
                if not len(own.hash):
                    continue
                value = found[m].held(own.hash, OWN)
                lost = np.isnan(value)
                total[mine] += np.bincount(own.text, np.where(lost, 0, value)[own.which], len(mine))
                n[mine] += np.bincount(own.text[~lost[own.which]], minlength=len(mine))
                if lost.any():
                    for i, part in own.of_texts(lost).groupby("text"):
                        which = part["which"].to_numpy()
                        beyond[int(mine[i])] = own.context[which], own.symbol[which], part["n"].to_numpy()
            for i in range(b - a):
                own = hashes[words.bounds[i] : words.bounds[i + 1]]
                counts = rule_counts(raw[a + i], own)
                size = len(bodies[a + i])
                measured = total[i], n[i], -by_class[i] / size if size else None
                rows.append((len(own), *counts, *measured, *beyond.get(i, (None,) * 3)))
        return pd.DataFrame(rows, columns=names)

    return docs.withColumn("_m", measure(F.col("text"), F.col("model")))


def assess(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """(doc_id, model, counts, log_perplexity, class_perplexity, low, high, class_low,
    class_high, base_failed, kept) of each row.

    A text fails the base rules with fewer than 20 words, or with more than 30 %
    of its words in repeated runs of eight. It is kept if it passes them and its
    perplexities, by code points and by classes of characters, lie within the bands of its
    language: the median of the texts that pass, plus and minus ``below`` and ``above`` times
    their median distance from it, wider for short texts (see ``Band``). Defined results: null and empty texts have no words and
    fail; null languages share a model with the empty one; repeated rows count as often as they occur; an empty table
    gives an empty one.
    """
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id",
        "text",
        F.coalesce(F.col("lang").cast("string"), F.lit(OTHER)).alias("model"),
    )
    counts = _written(count_grams(rows), "gram-counts")
    own, plain = counts.filter("gram is null"), counts.filter("gram is not null and not classes")
    plain = plain.select("model", "gram", "n")
    class_path = scratch_path(spark, "class-models")
    train(counts.filter("classes").select("model", "gram", "n")).write.parquet(class_path)
    of_classes = spark.read.parquet(class_path)
    mixed = [r.model for r in own.select("model").distinct().collect()]  # languages
    path = scratch_path(spark, "ngram-models")
    if mixed:
        every = widened(plain.filter(F.col("model").isin(mixed)))
        whole = own_models(every.unionByName(own.select("model", "context", "symbol", "n")))
        narrowed(whole).write.parquet(path)
        frequent_own(whole).write.mode("append").parquet(path)
    train(plain.filter(~F.col("model").isin(mixed))).write.mode("append").parquet(path)
    models = spark.read.parquet(path)
    both = models.select("model").unionByName(of_classes.select("model"))
    sizes = {r.model: r["count"] for r in both.groupBy("model").count().collect()}
    path = scratch_path(spark, "text-scores")
    # Languages whose texts have no characters have no model, and need none.
    packed = waves(sizes) or [[]]
    key = F.when(F.col("_m.context").isNotNull(), F.sha2("text", 256)).alias("text_key")
    for k, wave in enumerate(packed):
        mine = F.col("model").isin(wave)
        if k == 0:
            mine |= ~F.col("model").isin(list(sizes))
        part = rows if len(packed) == 1 else rows.filter(mine)
        found, shapes = (load(x.filter(F.col("model").isin(wave))) for x in (models, of_classes))
        _scores(part, found, shapes).select("doc_id", "model", key, "_m.*").write.mode("append").parquet(path)
    scored = spark.read.parquet(path)
    more = scored.filter("text_key is not null")
    scored = scored.drop("context", "symbol", "times")
    if mixed and not more.isEmpty():
        # Equal texts of a language have one score.
        key = ["model", "text_key"]
        once = more.dropDuplicates(key).select(
            *key, F.explode(F.arrays_zip("context", "symbol", "times")).alias("x")
        )
        sums = once.select(*key, "x.*").join(
            whole.hint("merge"), ["model", "context", "symbol"]
        ).groupBy(*key).agg(
            F.sum(F.col("times") * F.col("value")).alias("own_sum"), F.sum("times").alias("own_n")
        )
        both = scored.filter("text_key is not null").join(sums, key).withColumns(
            {"log_sum": F.col("log_sum") + F.col("own_sum"), "n_grams": F.col("n_grams") + F.col("own_n")}
        ).drop("own_sum", "own_n")
        both = both.unionByName(scored.filter("text_key is null"))
        scored = _written(both, "text-scores")
    scored = scored.withColumns(
        {
            "log_perplexity": -F.try_divide("log_sum", F.col("n_grams").cast("double")),
            "base_failed": (F.col("n_words") < 20)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30),
        }
    ).drop("log_sum", "n_grams", "text_key")
    banded = _banded(_banded(scored, "log_perplexity", "", band), "class_perplexity", "class_", band)
    inside = F.col("log_perplexity").between(F.col("low"), F.col("high"))
    inside &= F.col("class_perplexity").between(F.col("class_low"), F.col("class_high"))
    return banded.withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    )


def _banded(scored: DataFrame, value: str, prefix: str, band: Band) -> DataFrame:
    """``scored`` with the ends of the band of ``value``, low and high after a prefix."""
    passed = scored.filter(~F.col("base_failed"))
    middle = passed.groupBy("model").agg(F.percentile_approx(value, 0.5, 100_000).alias("middle"))
    # As many rows as models.
    spread = (
        passed.join(F.broadcast(middle), "model")
        .groupBy("model", "middle")
        .agg(
            F.percentile_approx(F.abs(F.col(value) - F.col("middle")), 0.5, 100_000).alias("spread")
        )
    )
    width = F.greatest(F.col("spread"), F.lit(band.least_spread))
    wider = F.sqrt(1 + band.short / F.greatest("word_chars", F.lit(1)))
    banded = scored.join(F.broadcast(spread.withColumn("_width", width)), "model", "left")
    return banded.withColumns(
        {
            f"{prefix}low": F.col("middle") - F.col("_width") * band.below * wider,
            f"{prefix}high": F.col("middle") + F.col("_width") * band.above * wider,
        }
    ).drop("middle", "spread", "_width")
