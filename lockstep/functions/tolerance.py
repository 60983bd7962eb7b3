"""Comparisons of times within a tolerance and round-off slack."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def spacing(x: Column) -> Column:
    """Distance from a positive double to the next larger one."""
    return F.pow(F.lit(2.0), F.floor(F.log2(x)) - 52)


def slack(*scales: Column) -> Column:
    """Ten spacings at the largest magnitude, of at least one."""
    return 10 * spacing(F.greatest(F.lit(1.0), *(F.abs(s) for s in scales)))


def within(a: Column, b: Column, tolerance: float | Column) -> Column:
    """Whether two values agree, each pair with its own slack; null if either is null."""
    apart, most = F.abs(a - b), F.lit(tolerance)
    # The slack takes a logarithm and a power, so it is asked for only where it decides: ten spacings are under 1e-14 of the magnitude.
    near = apart <= most + 1e-14 * F.greatest(F.lit(1.0), F.abs(a), F.abs(b))
    return (apart <= most) | (near & (apart <= most + slack(a, b)))


def near(a, b, tolerance: float) -> bool:
    """The same for sequences of numbers, with one slack for all."""
    if len(a) != len(b):
        return False
    scale = max([1.0, *(abs(x) for x in a), *(abs(x) for x in b)])
    return all(abs(x - y) <= tolerance + 10 * math.ulp(scale) for x, y in zip(a, b))


def near_each(a: float, b: float, tolerance: float) -> bool:
    return abs(a - b) <= tolerance + 10 * math.ulp(max(1.0, abs(a), abs(b)))


def seconds(latency: Column, rate: float | Column) -> Column:
    """Time of a one-based sample number."""
    return (latency - 1) / F.lit(rate)
