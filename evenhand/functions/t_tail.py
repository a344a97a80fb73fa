"""Tail probability of Student's t as a column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 1000
REACH = 40.0


def _area(start: Column, end: Column, freedom: Column) -> Column:
    """Integral of cos(s / sqrt(df))^(df - 1) by Simpson's rule; for many degrees of freedom the normal curve."""
    width = (end - start) / STEPS

    def term(i: Column) -> Column:
        sine = F.sin((start + width * i) / F.sqrt(freedom))
        # at a right angle the logarithm is minus infinity and the term zero
        height = F.when(sine < 1.0, F.exp((freedom - 1.0) * 0.5 * F.log1p(-sine * sine))).otherwise(
            F.when(freedom > 1.0, 0.0).otherwise(1.0)
        )
        weight = F.when((i == 0) | (i == STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return height * weight

    places = F.sequence(F.lit(0), F.lit(STEPS))
    return F.aggregate(places, F.lit(0.0), lambda total, i: total + term(i)) * width / 3.0


def two_sided(t: Column, freedom: Column) -> Column:
    """P(|T| > |t|) with ``freedom`` degrees of freedom, at least 1.

    With t = sqrt(df) tan(s / sqrt(df)) the density is a power of a cosine, so the tail is a share of an area that
    is finite at any df, and no difference of large logarithms is taken. Meant for a handful of result rows.
    """
    right_angle = F.sqrt(freedom) * (math.pi / 2)
    start = F.sqrt(freedom) * F.atan(F.abs(t) / F.sqrt(freedom))
    tail = _area(start, F.least(right_angle, start + REACH), freedom)
    whole = _area(F.lit(0.0), F.least(right_angle, F.lit(REACH)), freedom)
    usable = t.isNotNull() & ~F.isnan(t) & (freedom >= 1.0)
    return F.when(usable, F.when(F.abs(t) == float("inf"), 0.0).otherwise(F.least(F.lit(1.0), tail / whole)))
