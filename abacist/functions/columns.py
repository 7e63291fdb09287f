"""Column -> Column building blocks. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_USER = "(unknown user)"


def display_name(first: Column, last: Column, email: Column) -> Column:
    """Trimmed full name, else e-mail, else a placeholder. One NULL name part voids the pair."""
    full = F.trim(F.concat(first, F.lit(" "), last))
    return F.coalesce(F.nullif(full, F.lit("")), email, F.lit(UNKNOWN_USER))


# --- calendar ---------------------------------------------------------------------------------


def month_of(ts: Column, grain: str = "month") -> Column:
    """First day of the calendar month (or year, quarter, week) as DATE."""
    return F.trunc(ts, grain)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def seconds_between(later: Column, earlier: Column) -> Column:
    """``later - earlier`` in seconds, exact to the microsecond.

    Taken from the interval, not from ``unix_micros``: that one would read a timestamp without
    zone in the session zone and add or lose an hour around a clock change.
    """
    return (later - earlier).cast("interval second").cast("decimal(18,6)")


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed days rounded down, which counts 24-hour spans and not midnights."""
    return F.floor(seconds_between(later, earlier) / 86_400).cast("int")


# --- exact arithmetic -------------------------------------------------------------------------


def numeric(value: Column, digits: int) -> Column:
    """Round half up after removing binary noise, as a cast to exact numeric does."""
    return F.round(value.cast("decimal(28,10)"), digits).cast(f"decimal(18,{digits})")


def amount(units: Column, unit_price: Decimal) -> Column:
    """Money for a count of units, exact to the cent."""
    return F.round(units * F.lit(unit_price), 2).cast("decimal(18,2)")


def exchange(money: Column, rate: Decimal) -> Column:
    """Convert an already rounded amount, so that both currencies reconcile."""
    return F.round(money * F.lit(rate), 2).cast("decimal(18,2)")


def ratio(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` in decimals, NULL on a zero denominator."""
    return _rounded_quotient(num * F.lit(Decimal("1.0")), den, digits)


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """Share in percent, NULL on a zero denominator."""
    return _rounded_quotient(num * F.lit(Decimal("100.0")), den, digits)


def _rounded_quotient(num: Column, den: Column, digits: int) -> Column:
    quotient = num / F.nullif(den, F.lit(0))
    return F.round(quotient, digits).cast(f"decimal(18,{digits})")


def growth(current: Column, previous: Column) -> Column:
    """Change against the previous value in percent, NULL without or with a zero base."""
    return pct(current - previous, previous)


# --- price lists ------------------------------------------------------------------------------

# Document price list, upper bound of each bracket and price per document in it.
DOCUMENT_TIERS = ((500, 10), (1000, 9), (1500, 8), (2000, 7), (3000, 6), (5000, 5))
DOCUMENT_MINIMUM = 2990

# Price per million input and output tokens.
INPUT_TOKEN_PRICE = Decimal("2.101")
OUTPUT_TOKEN_PRICE = Decimal("8.41")


def quoted(name: str) -> str:
    """A column name that is taken as it stands, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def tiered_price(
    units: Column,
    tiers: Sequence[tuple[int, int]] = DOCUMENT_TIERS,
    minimum: int = DOCUMENT_MINIMUM,
    over_cap: str = "minimum",
) -> Column:
    """Marginal tier price: each bracket charges its own rate, the total has a floor.

    Every bracket contributes the units that fall into it, so no bracket start prices are
    needed. Beyond the last bracket there is no list price; ``over_cap`` bills the ``minimum``
    there or returns ``null``.
    """
    floors = [0, *[upper for upper, _ in tiers[:-1]]]
    charge = reduce(
        lambda a, b: a + b,
        [
            F.greatest(F.least(units, F.lit(upper)) - F.lit(lower), F.lit(0)) * F.lit(rate)
            for lower, (upper, rate) in zip(floors, tiers)
        ],
    )
    listed = F.greatest(charge, F.lit(minimum)).cast("bigint")
    beyond = F.lit(minimum if over_cap == "minimum" else None).cast("bigint")
    return F.when(units <= tiers[-1][0], listed).otherwise(beyond)


def needs_custom_price(units: Column, tiers: Sequence[tuple[int, int]] = DOCUMENT_TIERS) -> Column:
    """True beyond the last bracket, where the listed price is only the floor."""
    return units > tiers[-1][0]


def token_cost(
    prompt: Column,
    completion: Column,
    input_price: Decimal = INPUT_TOKEN_PRICE,
    output_price: Decimal = OUTPUT_TOKEN_PRICE,
) -> Column:
    """Unrounded cost of token counts at a price per million; pass sums, price once."""
    per_token = [p / 1_000_000 for p in (input_price, output_price)]
    return prompt * F.lit(per_token[0]) + completion * F.lit(per_token[1])


def band(
    value: Column, edges: Sequence[float], labels: Sequence[str], closed: str = "upper"
) -> Column:
    """Label of the band a value falls into.

    ``upper``: ``edges`` are inclusive upper bounds and the last label takes the rest.
    ``lower``: ``edges`` are inclusive lower bounds; values below the first get NULL.
    """
    if closed == "upper":
        label_of = F.lit(labels[-1])
        for edge, label in reversed(list(zip(edges, labels))):
            label_of = F.when(value <= edge, F.lit(label)).otherwise(label_of)
    else:
        label_of = F.lit(None).cast("string")
        for edge, label in zip(edges, labels):
            label_of = F.when(value >= edge, F.lit(label)).otherwise(label_of)
    return label_of
