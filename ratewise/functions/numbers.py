"""Rounding for printed scores.

``F.round`` and ``%.2f`` round the shortest decimal text of a double, half up.
Printed scores follow IEEE ``printf``: the exact binary value, ties to even
(4.625 prints as 4.62). The difference shows on averages over 8 or 40 ratings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_GRID = float(2**20)


def exact_round(x: Column, digits: int) -> Column:
    """Round a double on its exact value, ties to even.

    ``x`` is split into a part on a 2**-20 grid and a rest, so that both times
    10**digits are exact and the distance to the tie has the right sign. That
    holds below 2**22 in size; beyond, the shortest decimal text is rounded.
    """
    x = x.cast("double")
    scale = float(10**digits)
    coarse = F.floor(x * _GRID).cast("double") / _GRID
    rest = x - coarse
    below = F.floor(x * scale).cast("double")
    past_tie = (coarse * scale - below - 0.5) + rest * scale
    up = (past_tie > 0) | ((past_tie == 0) & (below % 2 != 0))
    exact = (below + F.when(up, 1.0).otherwise(0.0)) / scale
    return F.when(F.abs(x) < 2.0**22, exact).otherwise(F.bround(x, digits))


def fixed_text(x: Column, digits: int = 2) -> Column:
    """``x`` as text with a fixed number of decimals."""
    return F.format_string(f"%.{digits}f", exact_round(x, digits))


def score_text(entries: Column, score: str) -> Column:
    """An array of titled, scored structs as ``title (score) | title (score)``."""
    return F.concat_ws(
        " | ",
        F.transform(
            entries, lambda r: F.format_string("%s (%s)", r["title"], fixed_text(r[score]))
        ),
    )
