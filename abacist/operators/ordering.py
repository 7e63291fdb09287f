"""Presentation order of the reports.

Operators return unordered tables: a global sort is a range shuffle of its own, and most
consumers (matrices, further joins, an oracle) do not need it. ``in_report_order`` adds the
order in which a report is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sort columns per report, a leading "-" means descending.
REPORT_ORDER = {
    "usage_summary": ("user_name", "role_name"),
    "invoice_lines": ("line_order", "user_name", "role_name"),
    "mom_growth": ("user_name", "month"),
    "growth_matrix": ("user_name",),
    "consumption_trend": ("month", "user_name"),
    "ytd_cumulative": ("month",),
    "daily_volume": ("day", "user_name"),
    "daily_matrix": ("user_name",),
    "batch_efficiency": ("-items_per_case", "user_name"),
    "usage_pareto": ("rank", "user_name"),
    "status_distribution": ("user_name", "status_id"),
    "status_matrix": ("user_name",),
    "match_quality": ("month", "user_name"),
    "quality_matrix": ("user_name",),
    "state_funnel": ("month", "state_id"),
    "funnel_matrix": ("month",),
    "settled_rate": ("month",),
    "stage_latency": ("month",),
    "candidate_depth": ("month", "user_name"),
    "attach_rate": ("month",),
    "volume_band": ("month", "-billable_items", "user_name"),
    "client_invoice": ("client_name",),
    "client_mom_growth": ("client_name", "month"),
    "client_daily_volume": ("day", "client_name"),
    "client_revenue_trend": ("month", "client_name"),
    "client_state_distribution": ("client_name", "state_id"),
    "job_efficiency": ("-records_per_job", "client_name"),
    "ytd_revenue": ("month",),
    "tier_distribution": ("month", "-records_created", "client_name"),
    "client_pareto": ("rank", "client_name"),
    "llm_cost_by_client_month": ("-month", "-total_cost_eur", "client_name"),
    "llm_latency_by_client": ("-avg_elapsed_sec", "client_name"),
    "token_efficiency": ("-total_cost_eur", "client_name"),
    "calls_per_record": ("-calls_per_record", "client_name"),
    "model_usage_monthly": ("-month", "-llm_calls", "model_name"),
    "llm_daily_volume": ("day",),
    "slowest_calls": ("-elapsed_time_seconds", "record_id"),
    "llm_cost_trend": ("month",),
    "select_sprints": ("seq",),
    "carryover_matrix": ("-TOTAL", "assignee"),
    "team_trend": ("seq",),
    "tickets_for": ("sprint_end", "issue_key"),
    "repeat_offenders": ("-times_carried", "issue_key", "assignee"),
    "carryover_rate": ("assignee",),
    "count_by": ("-count",),
    "monthly_volume": ("month",),
    "ordered_priority": ("ordinal",),
    "assignee_workload": ("total", "assignee"),
    "top_reporters": ("-total", "reporter"),
    "oldest_open": ("-age_days", "created", "key"),
    "resolution_histogram": ("bin",),
    "median_resolution_by_type": ("median_days", "issuetype"),
    "month_category_matrix": ("month",),
    "ticket_export": ("-created", "key"),
}


def in_report_order(df: DataFrame, report: str) -> DataFrame:
    """Sort a finished report the way it is presented; NULL comes last either way."""
    keys = [
        F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last()
        for k in REPORT_ORDER[report]
    ]
    return df.orderBy(*keys)
