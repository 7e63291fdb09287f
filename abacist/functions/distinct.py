"""Distinct counts that can be stored and added up.

A sketch of the distinct values of a group (HyperLogLog) has a fixed size, and sketches of days, models or
clients are united to those of months, years and all clients. The exact count is the default everywhere;
a report takes the sketch where its tables say so.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

LG_K = 14  # log2 of a sketch's registers: 0.8 % standard error, up to 16 kB


def distinct_sketch(value: str | Column, lg_k: int = LG_K) -> Column:
    """Aggregate: the sketch of the distinct values; NULLs do not count."""
    x = F.col(value) if isinstance(value, str) else value
    return F.hll_sketch_agg(x.cast("string"), F.lit(lg_k))


def united(sketch: str | Column) -> Column:
    """Aggregate: the sketch of all values that several sketches have seen."""
    return F.hll_union_agg(sketch)


def estimate(sketch: str | Column) -> Column:
    """Number of distinct values of a sketch; a group without any has 0."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("bigint")


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate, that of united sketches included."""
    return 1.04 / sqrt(1 << lg_k)
