"""Rounding and ratio helpers that give the same digits in every engine.

A mean is rounded from its exactly scaled value ``10**d * sum / count``: for
integer-valued inputs that quotient is one correctly rounded division, so a
true tie (``x.5``) is seen as a tie everywhere, not lost in the binary form of
the unscaled mean.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_round(numerator: Column, denominator: Column, digits: int,
                 half_even: bool = True) -> Column:
    """round(numerator / denominator, digits) computed on the scaled quotient.

    ``half_even`` matches Python's ``round``; otherwise half-up as in SQL
    ``ROUND``. A zero denominator gives NULL.
    """
    scale = 10 ** digits
    q = (numerator.cast("double") * F.lit(float(scale))) / F.nullif(denominator.cast("double"), F.lit(0.0))
    r = F.bround(q, 0) if half_even else F.round(q, 0)
    return r / F.lit(float(scale))


def mean_rounded(col: Column, digits: int, half_even: bool = True) -> Column:
    """Aggregate: mean of ``col`` rounded to ``digits`` (see module note)."""
    return scaled_round(F.sum(col), F.count(col), digits, half_even)


def round6(col: Column) -> Column:
    """Report precision for unrounded statistics (means, deviations)."""
    return F.round(col, 6)


def mean6(col: Column) -> Column:
    """Aggregate: mean of ``col`` at report precision (6 dp, half-up, scaled)."""
    return scaled_round(F.sum(col), F.count(col), 6, half_even=False)


def ratio6(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator at report precision (6 dp, half-up, scaled)."""
    return scaled_round(numerator, denominator, 6, half_even=False)


def tenths_threshold(threshold: float) -> int:
    """Smallest whole number of tenths t with t / 10 >= ``threshold``.

    Scores are kept in integer tenths, so ``score >= threshold`` is
    ``tenths >= tenths_threshold(threshold)`` exactly (e.g. 0.45 -> 5).
    """
    return math.ceil(round(threshold * 10, 9))
