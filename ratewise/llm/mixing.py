"""Sampling documents so that their tokens meet target shares of several kinds.

Tokens are added up by source, language and topic; iterative proportional
fitting scales the cells in turn to each target, with no probability above one,
and documents are drawn by a hash of their content. Where no probabilities up to
one meet the targets, the shares go towards them as far as they can, and what was
wanted and reached is reported.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.text import words

OTHER = "other"
#: Error of a share, of all sampled tokens, up to which a target counts as met.
MET = 1e-4


@dataclass(frozen=True)
class Targets:
    """Shares of tokens by margin; what isn't listed falls into ``other``.

    ``other`` is listed too, or else keeps its share of the data, and the listed
    shares are scaled to what it leaves. The cells are the product of the lists,
    so their number doesn't grow with the documents.
    """

    source: dict[str, float] = field(default_factory=dict)
    lang: dict[str, float] = field(default_factory=dict)
    topic: dict[str, float] = field(default_factory=dict)

    def margins(self) -> dict[str, dict[str, float]]:
        return {"source": self.source, "lang": self.lang, "topic": self.topic}


def surface_topic(text: Column) -> Column:
    """A topic from the surface of a text: markup, note, list or prose."""
    whole = F.coalesce(text, F.lit(""))
    size = F.octet_length(whole)
    bare = whole
    for mark in "#*$%&|<>":
        bare = F.replace(bare, F.lit(mark), F.lit(""))
    marks = size - F.octet_length(bare)
    lines = size - F.octet_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    return (
        F.when(marks * 50 > size, "markup")
        .when(size < 500, "note")
        .when(lines * 80 > size, "list")
        .otherwise("prose")
    )


def _category(value: Column, listed: dict[str, float]) -> Column:
    names = [n for n in listed if n != OTHER]
    return F.when(value.isin(names), value).otherwise(OTHER) if names else F.lit(OTHER)


def categories(targets: Targets, topic: Column | None = None) -> dict[str, Column]:
    """The cell of a document: expressions of its source, lang and topic."""
    values = {"source": F.col("source"), "lang": F.col("lang")}
    values["topic"] = surface_topic(F.col("text")) if topic is None else topic
    return {k: _category(values[k], t) for k, t in targets.margins().items()}


class OutOfReach(UserWarning):
    """Some targets can't be met by probabilities up to one."""


@dataclass(frozen=True)
class Margin:
    """Shares of one category: held by the data, wanted, aimed at and expected of the sample."""

    margin: str
    category: str
    held: float
    wanted: float
    aimed: float
    expected: float


@dataclass(frozen=True)
class Raked:
    """Probabilities of the cells and how far they meet the targets.

    ``strength`` is 1 where the targets themselves are met and falls to 0 as
    the aimed shares go back to those held. ``error`` is the largest difference of
    an expected share and the one aimed at, or of the expected tokens and
    ``fraction``, as a part of these.
    """

    probability: dict[tuple[str, str, str], float]
    margins: tuple[Margin, ...]
    strength: float
    tokens: float  # expected of the sample
    error: float

    @property
    def met(self) -> bool:
        return self.strength == 1 and self.error <= MET


def _shares(tokens: dict, targets: Targets) -> list[tuple[str, list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """(margin, categories, category of each cell, held and wanted shares) of each margin."""
    cells = sorted(tokens)
    size = np.array([tokens[c] for c in cells], float)
    out = []
    for k, (margin, listed) in enumerate(targets.margins().items()):
        names = sorted({c[k] for c in cells})
        index = np.array([names.index(c[k]) for c in cells])
        held = np.bincount(index, size, len(names)) / size.sum()
        # An unlisted other keeps what it holds, and the listed ones share the rest.
        kept = np.array([h if n == OTHER and n not in listed else 0.0 for n, h in zip(names, held)])
        share = np.array([listed.get(n, 0.0) for n in names])
        if share.sum():
            share = kept + share / share.sum() * (1 - kept.sum())
        else:
            share = kept / kept.sum() if kept.sum() else held
        out.append((margin, names, index, held, share))
    return out


def _aimed(held: np.ndarray, wanted: np.ndarray, strength: float) -> np.ndarray:
    """Shares on the geometric path from those held to those wanted."""
    if strength == 1:
        return wanted
    between = held ** (1 - strength) * wanted**strength
    return between / between.sum() if between.sum() else held


def rake(
    tokens: dict[tuple[str, str, str], float],
    targets: Targets,
    fraction: float,
    sweeps: int = 200,
    tolerance: float = 1e-9,
    strength: float = 1.0,
) -> dict[tuple[str, str, str], float]:
    """Probability of each cell, so that expected tokens meet the targets.

    Each sweep scales the cells to every margin in turn and bounds them by one.
    Targets that the data can't reach are met as far as the bound allows;
    ``calibrate`` says whether they are.
    """
    cells = sorted(tokens)
    size = np.array([tokens[c] for c in cells], float)
    total = size.sum()
    p = np.full(len(cells), float(fraction))
    if not total:
        return dict(zip(cells, p))
    groups = [
        (index, _aimed(held, wanted, strength) * total * fraction)
        for _, _, index, held, wanted in _shares(tokens, targets)
    ]
    for _ in range(sweeps):
        before = p
        for index, wanted in groups:
            now = np.bincount(index, p * size, len(wanted))
            factor = np.divide(wanted, now, out=np.ones_like(now), where=now > 0)
            p = np.minimum(1.0, p * factor[index])
        if np.abs(p - before).max() < tolerance:
            break
    return dict(zip(cells, p.tolist()))


def _measure(tokens: dict, targets: Targets, fraction: float, strength: float) -> Raked:
    """The cells raked to the aimed shares of a strength, and what comes out."""
    p = rake(tokens, targets, fraction, strength=strength)
    cells = sorted(tokens)
    size = np.array([tokens[c] for c in cells], float)
    drawn = np.array([p[c] for c in cells]) * size
    whole = drawn.sum()
    error = abs(whole / (size.sum() * fraction) - 1)
    margins = []
    for margin, names, index, held, wanted in _shares(tokens, targets):
        aimed = _aimed(held, wanted, strength)
        expected = np.bincount(index, drawn, len(names)) / whole if whole else np.zeros(len(names))
        error = max(error, np.abs(expected - aimed).max())
        margins += [Margin(margin, n, *map(float, x)) for n, *x in zip(names, held, wanted, aimed, expected)]
        # What is wanted of a category without any tokens can't come.
        listed = targets.margins()[margin]
        absent = sorted(n for n, x in listed.items() if x and n not in names)
        margins += [Margin(margin, n, 0.0, listed[n] / sum(listed.values()), 0.0, 0.0) for n in absent]
    return Raked(p, tuple(margins), strength, float(whole), float(error))


def calibrate(
    tokens: dict[tuple[str, str, str], float], targets: Targets, fraction: float, strict: bool = False
) -> Raked:
    """Probabilities that meet the targets, or shares as near to them as can be met.

    If the targets can't be met within ``MET``, the aimed shares are those on
    the geometric path from the held ones (strength 0, always met by the plain
    fraction) to the wanted ones, at the greatest strength that is met, and so
    is the expected number of tokens; a warning ``OutOfReach`` names the
    categories that stay off their share, or is raised if ``strict``. So does a
    listed category without any tokens. Without tokens every cell gets the
    plain fraction and there are no margins.
    """
    if not sum(tokens.values()):
        return Raked(rake(tokens, targets, fraction), (), 1.0, 0.0, 0.0)
    best = _measure(tokens, targets, fraction, 1.0)
    if best.error > MET:
        low, high = 0.0, 1.0
        best = _measure(tokens, targets, fraction, low)
        for _ in range(20):
            middle = (low + high) / 2
            tried = _measure(tokens, targets, fraction, middle)
            if tried.error > MET:
                high = middle
            else:
                low, best = middle, tried
    off = [m for m in best.margins if abs(m.expected - m.wanted) > 2 * MET]
    if off:
        told = ", ".join(f"{m.margin} {m.category}: {m.expected:.4f} for {m.wanted:.4f}" for m in off)
        problem = OutOfReach(f"targets out of reach (strength {best.strength:.3f}): {told}")
        if strict:
            raise problem
        warnings.warn(problem, stacklevel=2)
    return best


def mix(
    docs: DataFrame, targets: Targets, fraction: float = 0.5, seed: int = 0,
    topic: Column | None = None, prefix: str = "_", strict: bool = False,
) -> DataFrame:
    """``docs`` with _source, _lang, _topic, _tokens, _probability, _weight and _sampled.

    ``_weight`` is one over the probability, null where that is zero. A row is
    sampled if a hash of its doc_id and text lies below the probability, so equal
    rows are drawn together and a repeated run draws the same. The added columns
    begin with ``prefix`` and take the place of any of the same name. Defined results: null source or
    lang is ``other``; null and empty texts have no tokens; a cell without
    tokens is drawn with the plain fraction; an empty table gives an empty one.
    Targets out of reach are approached, with a warning or, if ``strict``, an error
    (see ``calibrate``).
    """
    spark = docs.sparkSession
    cell_of = {f"{prefix}{k}": c for k, c in categories(targets, topic).items()}
    names = list(cell_of)
    tokens, probability, weight, sampled = (
        f"{prefix}{k}" for k in ("tokens", "probability", "weight", "sampled")
    )
    added = [*names, tokens, probability, weight, sampled]
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in map(str.lower, added)]
    marked = docs.select(
        *others,
        *[c.alias(n) for n, c in cell_of.items()],
        F.size(words(F.col("text"))).cast("bigint").alias(tokens),
    )
    # One row for each product of listed categories.
    held = marked.groupBy(*names).agg(F.sum(tokens).alias("n")).collect()
    found = calibrate({tuple(r[:3]): float(r[3]) for r in held}, targets, fraction, strict).probability
    rows = [(*cell, float(p)) for cell, p in found.items()]
    schema = ", ".join([*(f"{n} string" for n in names), f"{probability} double"])
    cells = spark.createDataFrame(rows, schema)
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11) / F.lit(2.0**53)
    mixed = marked.join(F.broadcast(cells), names).withColumns(
        {weight: F.try_divide(F.lit(1.0), probability), sampled: place < F.col(probability)}
    )
    return mixed.select(*others, *added)
