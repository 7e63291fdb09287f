"""Exact continuous percentiles that never hold a group in one task.

Spark's ``percentile`` keeps one map entry per distinct value of a group. That is right for
day counts or case sizes and is used there, but a month of microsecond latencies, or one client
with a third of all calls, would put its whole group into the memory of a single task.

Here a bounded sketch gives a narrow bracket around each wanted rank. Sketches can be merged: callers take
them in the fold that they run anyway (``sketch``), and merge them where the folds are added up (``merged_sketch``).
One further pass over the rows meets one row of brackets per group: what lies below a bracket is counted,
what lies inside is counted in ``bins`` equal stretches, and only the distinct values inside are kept. The bin
that holds the rank is then known from the counts, and only its values are put in order.

The sketch steers the amount of work, not the result. A bracket reaches several times as far as the
error of the sketch. Should one not hold its rank nevertheless, its group is selected again within all its
values; the rows for that come from the same shuffle, and none are read while there is no such group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.functions.joins import join_on_group

# Size of a sketch, and how far a bracket reaches to either side, as a share of its group: about four times
# the rank error that 99 of 100 sketches of this size stay within (0.05 %).
SIZE = 8192
REACH = 0.002


def sketch(value: str | Column, name: str = "", size: int = SIZE) -> list[Column]:
    """Aggregates of a fold that ``merged_sketch`` adds up; groups without values have a NULL sketch."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    # the library's sketch has no place for infinite values: they count at the ends
    finite = F.when(x.isNotNull() & ~F.isnan(x), F.greatest(F.least(x, F.lit(_MOST)), F.lit(-_MOST)))
    return [
        F.struct(
            F.count(x).alias("n"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            F.when(F.count(finite) > 0, F.kll_sketch_agg_double(finite, F.lit(size))).alias("kll"),
        ).alias(f"_sketch{name}")
    ]


_MOST = 1.7976931348623157e308


def merged_sketch(name: str = "", size: int = SIZE) -> list[Column]:
    """The sketch of several folds together."""
    s = F.col(f"_sketch{name}")
    return [
        F.struct(
            F.sum(s["n"]).alias("n"),
            F.min(s["min"]).alias("min"),
            F.max(s["max"]).alias("max"),
            F.when(F.count(s["kll"]) > 0, F.kll_merge_agg_double(s["kll"], F.lit(size))).alias("kll"),
        ).alias(f"_sketch{name}")
    ]


def sketch_quantile(p: str, name: str = "") -> Column:
    """The approximate quantile that a sketch gives by itself."""
    s = F.col(f"_sketch{name}")
    return F.when(s["kll"].isNotNull(), F.kll_sketch_get_quantile_double(s["kll"], F.lit(float(p))))


def _targets(quantiles: Sequence[Fraction], at: str, reach: float) -> Column:
    """Bracket, rank of the lower neighbour and fraction towards the upper one, per quantile."""
    s = F.col(at)
    probes = [float(min(max(p + side, 0), 1)) for p in quantiles for side in (-Fraction(reach), Fraction(reach))]
    probe = F.kll_sketch_get_quantile_double(s["kll"], F.array(*[F.lit(x) for x in probes]))
    every = []
    for number, p in enumerate(quantiles):
        # a small group, or one with an end in reach, is counted out to its end
        ends = [s["min"], s["max"]]
        edges = [
            F.when((s["n"] * reach >= 3) & F.lit(0 < x < 1), probe[2 * number + side]).otherwise(ends[side])
            for side, x in enumerate(probes[2 * number : 2 * number + 2])
        ]
        every.append(_target(number, p, s["n"], F.greatest(edges[0], ends[0]), F.least(edges[1], ends[1])))
    return F.array(*every)


def _target(number: int, p: Fraction, n: Column, low: Column, high: Column) -> Column:
    scaled = (n - 1) * p.numerator
    return F.struct(
        F.lit(number).alias("q"),
        scaled.alias("scaled"),
        F.lit(p.denominator).cast("bigint").alias("of"),
        low.cast("double").alias("low"),
        high.cast("double").alias("high"),
    )


def grouped_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, str],
    *,
    sketches: DataFrame | None = None,
    name: str = "",
    few_groups: bool = False,
    spread: Sequence[str] = (),
    reach: float = REACH,
    bins: int = 1024,
    salt: int = 8,
) -> DataFrame:
    """One row per group with each named quantile (``{"p95": "0.95"}``) as DOUBLE.

    NULL values are ignored; a group with nothing but NULL has no row. ``sketches`` holds the keys
    and the column of ``sketch`` or ``merged_sketch`` (with the same ``name``), else it is taken in a pass
    of its own. ``few_groups`` states that the number of groups has a fixed bound (calendar months,
    say), so that the table of brackets may be broadcast. Without it the rows are spread over
    ``salt`` slices of their group by the hash of the value and of ``spread`` (columns that vary
    inside a group where the value does not, preferably ones the rows are joined on anyway), and
    the adaptive planner decides on a broadcast from the measured size.
    """
    keys = list(keys)
    rows = rows.where(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    wanted = [Fraction(p) for p in quantiles.values()]
    if sketches is None:
        sketches = rows.groupBy(*keys).agg(*sketch(value, name))
    s = F.col(f"_sketch{name}")
    known = sketches.where(s["n"] > 0)
    brackets = known.select(*keys, _targets(wanted, f"_sketch{name}", reach).alias("_t"))
    if few_groups:
        rows, slices = rows.select(*keys, F.col(value).alias("_v")), []
    else:
        part = F.pmod(F.xxhash64(value, *spread), F.lit(salt))
        rows, slices = rows.select(*keys, F.col(value).alias("_v"), part.alias("_slice")), ["_slice"]

    found = _selected(rows, brackets, keys, slices, few_groups, salt, bins)
    whole = [_target(i, p, s["n"], s["min"], s["max"]) for i, p in enumerate(wanted)]
    missed = found.where(F.col("_value").isNull()).select(*keys).distinct()
    again = join_on_group(known.select(*keys, F.array(*whole).alias("_t")), missed, keys)
    found = found.union(_selected(rows, again, keys, slices, few_groups, salt, bins))
    return found.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_q") == i, F.col("_value"))).alias(n) for i, n in enumerate(quantiles)]
    )


def _selected(
    rows: DataFrame, brackets: DataFrame, keys: list[str], slices: list[str], few: bool, salt: int, bins: int
) -> DataFrame:
    """Keys, number of the quantile and its value, NULL where the bracket does not hold its rank."""
    if few:
        targets = F.broadcast(brackets)
    else:
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))
        targets = brackets.withColumn("_slice", F.explode(every))

    # bin -1 holds what lies below a bracket, 0 .. bins - 1 the bracket, bins what lies above it
    def bin_of(x: Column, t: Column) -> Column:
        width = t["high"] - t["low"]
        inner = F.when(
            (width > 0) & (width < float("inf")),
            F.least(F.floor((x - t["low"]) / width * bins), F.lit(bins - 1)).cast("int"),
        ).otherwise(F.lit(0))
        return F.when(x < t["low"], F.lit(-1)).when(x > t["high"], F.lit(bins)).otherwise(inner)

    met = join_on_group(rows, targets, [*keys, *slices]).select(*keys, F.explode("_t").alias("_t"), "_v")
    place = bin_of(F.col("_v"), F.col("_t"))
    # rank and fraction travel with the counts: they depend on the group and the quantile only
    group = [*keys, "_q", "_scaled", "_of"]
    counted = met.select(
        *keys,
        F.col("_t.q").alias("_q"),
        F.col("_t.scaled").alias("_scaled"),
        F.col("_t.of").alias("_of"),
        place.alias("_bin"),
        F.when((place >= 0) & (place < bins), F.col("_v")).alias("_v"),
    )
    counted = counted.groupBy(*group, "_bin", "_v").agg(F.count(F.lit(1)).alias("_c"))
    return _picked(counted, group, few)


def _picked(counted: DataFrame, group: list[str], few: bool) -> DataFrame:
    """From counts per (bin, distinct value) to the quantiles."""
    per_bin = counted.groupBy(*group, "_bin").agg(F.sum("_c").alias("_in"))
    # at most ``bins`` + 2 rows per group and quantile
    upto = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    per_bin = per_bin.withColumn("_upto", F.sum("_in").over(upto))
    rank, rest = F.expr("_scaled div _of"), F.expr("_scaled % _of")
    next_rank = rank + (rest > 0).cast("int")
    # the bins that hold the two neighbours of the rank
    held = per_bin.where(
        ((F.col("_upto") > rank) & (F.col("_upto") - F.col("_in") <= rank))
        | ((F.col("_upto") > next_rank) & (F.col("_upto") - F.col("_in") <= next_rank))
    )
    inside = join_on_group(counted, F.broadcast(held) if few else held, [*group, "_bin"])
    order = Window.partitionBy(*group, "_bin").orderBy("_v")
    ranked = inside.withColumn(
        "_to", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_upto") - F.col("_in")
    )
    picked = ranked.groupBy(*group).agg(
        F.min(F.when(F.col("_to") > rank, F.struct("_bin", "_v"))).alias("_lo"),
        F.min(F.when(F.col("_to") > next_rank, F.struct("_bin", "_v"))).alias("_hi"),
    )
    low, high = F.col("_lo._v"), F.col("_hi._v")
    # a neighbour outside its bracket has no value
    mixed = low + (high - low) * (rest / F.col("_of"))
    value = F.when(low.isNull() | high.isNull(), F.lit(None).cast("double"))
    value = value.when((rest == 0) | (low == high) | (low == float("-inf")), low).otherwise(mixed)
    return picked.select(*group[:-2], value.alias("_value"))
