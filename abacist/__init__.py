"""Reporting operators for billing, KPI and ticket data, written as Spark DataFrame plans."""

from abacist.bindings import (
    Period,
    Pricing,
    RecordTables,
    TokenTables,
    UsageRules,
    UsageTables,
    bind,
)
from abacist.session import get_session

__all__ = [
    "Period",
    "Pricing",
    "RecordTables",
    "TokenTables",
    "UsageRules",
    "UsageTables",
    "bind",
    "get_session",
]
