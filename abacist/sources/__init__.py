from abacist.sources.landed import (
    discover_sla_fields,
    read_sprint_reports,
    read_sprints,
    read_tickets,
    ticket_schema,
    unreadable_sprint_pages,
    unreadable_sprint_reports,
    unreadable_ticket_pages,
    unreported_sprints,
)
from abacist.sources.shared import new_dir, shared_dir
from abacist.sources.sinks import bundle_entries, read_bundle, report_bundle
from abacist.sources.tables import read_table, read_tables

__all__ = [
    "bundle_entries",
    "discover_sla_fields",
    "new_dir",
    "read_bundle",
    "read_sprint_reports",
    "read_sprints",
    "read_table",
    "read_tables",
    "read_tickets",
    "report_bundle",
    "shared_dir",
    "ticket_schema",
    "unreadable_sprint_pages",
    "unreadable_sprint_reports",
    "unreadable_ticket_pages",
    "unreported_sprints",
]
