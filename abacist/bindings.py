"""Roles to columns: which table and column plays which part in a report.

Operators read canonical column names (``case_id``, ``created_at`` ...). ``bind`` projects any
table onto them. It is a plain ``select``, so Catalyst prunes and pushes straight through it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, **roles: str | Column) -> DataFrame:
    """Project ``df`` onto canonical names; a string is a SQL expression over ``df``."""
    return df.select(
        *[(F.expr(e) if isinstance(e, str) else e).alias(role) for role, e in roles.items()]
    )


@dataclass(frozen=True)
class Period:
    """Half-open reporting period: midnight on ``end`` belongs to the next period."""

    start: date
    end: date

    @classmethod
    def month(cls, year: int, month: int) -> Period:
        return cls(date(year, month, 1), date(year + month // 12, month % 12 + 1, 1))

    @classmethod
    def year(cls, year: int) -> Period:
        return cls(date(year, 1, 1), date(year + 1, 1, 1))

    def contains(self, column: Column) -> Column:
        """Range predicate on the raw column, so it reaches the Parquet scan."""
        return (column >= F.lit(self.start)) & (column < F.lit(self.end))

    @property
    def last(self) -> date:
        """The last day inside the period."""
        return date.fromordinal(self.end.toordinal() - 1)

    def months(self) -> list[str]:
        """Every ``yyyy-MM`` label of the period, in order."""
        first, last = (d.year * 12 + d.month - 1 for d in (self.start, self.end))
        return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last)]

    def days(self) -> list[str]:
        """Every ``dd`` label of a one-month period, in order."""
        if (self.start.year, self.start.month) != (self.last.year, self.last.month):
            raise ValueError(f"{self.start} to {self.end} is more than one month")
        return [f"{d:02d}" for d in range(self.start.day, self.last.day + 1)]


@dataclass(frozen=True)
class Pricing:
    """Flat usage price, one fixed fee per active month, and the invoice exchange rate."""

    # Price per item, monthly fee, exchange rate.
    unit_price: Decimal = Decimal("0.035")
    fee: Decimal = Decimal("650.00")
    fx: Decimal = Decimal("25.0")


@dataclass(frozen=True)
class UsageRules:
    """What counts as billable usage.

    ``excluded_users`` is a tuple of ids, or a DataFrame with one ``user_id`` column when the
    list lives in a table. Cases without a user are kept in both forms. Reports list users by
    name, so namesakes are one line; ``by_user_id`` keeps them apart and shows the id.
    """

    # Billable item statuses; the first case state that counts as settled is below.
    billable: tuple[int, ...] = (2, 4, 5)
    excluded_users: tuple | DataFrame = ()
    include_deleted: bool = True
    settled_min_state: int = 4
    by_user_id: bool = False


@dataclass(frozen=True)
class UsageTables:
    """Canonical tables of the user -> case -> item -> offer -> accessory hierarchy.

    ``grain`` is a stored ``usage.daily_grain``. With it, the reports on cases and billable items
    per user and time read that table instead of cases and items; its rules are already applied.

    ``case_item`` may have ``case_created_at``, the creation time of the item's case (a partition
    column, say). Reports of a period then read only that part of the items.
    """

    case: DataFrame | None = None
    case_item: DataFrame | None = None
    user: DataFrame | None = None
    user_role: DataFrame | None = None
    case_state: DataFrame | None = None
    item_status: DataFrame | None = None
    offer_item: DataFrame | None = None
    product_accessory: DataFrame | None = None
    grain: DataFrame | None = None
    rules: UsageRules = field(default_factory=UsageRules)


@dataclass(frozen=True)
class RecordTables:
    """Canonical tables of document billing; ``by_client_id`` keeps clients of one name apart."""

    record: DataFrame
    client: DataFrame
    by_client_id: bool = False


@dataclass(frozen=True)
class TokenTables:
    """Canonical tables of model usage; record and client only where a report names clients.

    ``by_client_id`` keeps clients of one name apart. Distinct records are counted exactly, or estimated by
    sketches of ``distinct_lg_k`` where that is given. ``grain`` is a stored ``tokens.token_grain``; the reports
    on calls, tokens, cost and records then read it instead of the calls, and estimate records by its sketches.
    """

    usage: DataFrame | None = None
    record: DataFrame | None = None
    client: DataFrame | None = None
    by_client_id: bool = False
    distinct_lg_k: int | None = None
    grain: DataFrame | None = None
