"""Join of points with the intervals they lie in, by equality only.

An interval is cut into the two or three blocks of the power of two next to its length that it touches; a
point lies in one block of every such size. Both sides then meet on (keys, size, block), which is a hash or
merge join however the intervals lie, and each pair meets once. Few sizes occur: 63 at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.functions.joins import join_on_group

_OPEN = 1 << 61


def _block(x: Column, level: Column) -> Column:
    return F.call_function("shiftright", x, level)


def interval_join(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], point: str, low: str, high: str, how: str = "inner"
) -> DataFrame:
    """Rows of both sides with equal ``keys`` (NULL matches NULL) and ``low <= point < high``.

    The three are whole numbers below 2**61 in size; a NULL bound is open, a NULL point lies nowhere. Empty
    intervals match nothing. ``how`` is ``inner`` or ``left_semi``.
    """
    at, start, end = F.col(point).cast("bigint"), F.col("_low"), F.col("_high")
    ranges = intervals.withColumns(
        {
            "_low": F.coalesce(F.col(low).cast("bigint"), F.lit(-_OPEN)),
            "_high": F.coalesce(F.col(high).cast("bigint"), F.lit(_OPEN)),
        }
    ).where(start < end)
    # any level is right; the one next to the length makes the fewest blocks
    ranges = ranges.withColumn("_level", F.ceil(F.log2((end - start).cast("double"))).cast("int"))
    levels = ranges.agg(F.collect_set("_level")).scalar()
    blocks = F.sequence(_block(start, F.col("_level")), _block(end - 1, F.col("_level")))
    ranges = ranges.withColumn("_block", F.explode(blocks))
    met = points.where(at.isNotNull()).withColumn("_level", F.explode(levels))
    met = met.withColumn("_block", _block(at, F.col("_level")))
    inside = (start <= at) & (at < end)
    found = join_on_group(met, ranges, [*keys, "_level", "_block"], how, inside)
    return found.drop("_level", "_block", "_low", "_high")
