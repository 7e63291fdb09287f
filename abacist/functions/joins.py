"""Join helper for report keys, where NULL is a group of its own."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on_group(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    also: Column | None = None,
) -> DataFrame:
    """Equi-join on ``keys`` with NULL matching NULL; the right side's keys are dropped.

    Renaming the right keys also keeps the join unambiguous when both sides come from one table.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    if also is not None:
        on.append(also)
    joined = left.join(renamed, reduce(lambda a, b: a & b, on), how)
    return joined.drop(*[f"_r_{k}" for k in keys])
