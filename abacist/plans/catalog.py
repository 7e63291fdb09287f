"""Registered queries: every operator on the generated tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.bindings import TokenTables
from abacist.functions import display_name, standard_error, tiered_price, token_cost
from abacist.functions.columns import needs_custom_price
from abacist.operators import reconcile
from abacist.operators import records as rec
from abacist.operators import sprints as spr
from abacist.operators import stored
from abacist.operators import tickets as tic
from abacist.operators import tokens as tok
from abacist.operators import usage as use
from abacist.operators.matrix import amount_pareto
from abacist.operators.usage import CASE_STATES
from abacist.plans import testdata as data
from abacist.sources import new_dir, read_bundle, read_sprint_reports, report_bundle, unreadable_sprint_reports

Query = Callable[[SparkSession, str], DataFrame]

MONTHS = data.YEARS.months()
SPRINTS = data.sprint_names()
PERSON = "NATION_3"


def _usage(report: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: report(data.usage(spark, sf), *args, **kwargs)


def _records(report: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: report(data.records(spark, sf), *args, **kwargs)


def _tokens(report: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: report(data.tokens(spark, sf), *args, **kwargs)


def _monthly_tokens(report: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: report(data.monthly_tokens(spark, sf), *args, **kwargs)


def _issues(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: report(data.sprint_issues(spark, sf))


def _carried(report: Callable[[DataFrame], DataFrame]) -> Query:
    return _issues(lambda issues: report(spr.carryover_rows(issues)))


def _tickets(report: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: report(data.flat_tickets(spark, sf), *args, **kwargs)


# --- scalar functions -------------------------------------------------------------------------


def display_names(spark: SparkSession, sf: str) -> DataFrame:
    name = display_name(F.col("first_name"), F.col("last_name"), F.col("email"))
    return data.users(spark, sf).select("user_id", name.alias("user_name"))


def tiered_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Prices for every stock count from nothing to beyond the last tier."""
    units = F.floor("p_retailprice").cast("bigint") * 3 - 2600
    return data.table(spark, sf, "part").select(
        "p_partkey",
        units.alias("units"),
        tiered_price(units).alias("price"),
        tiered_price(units, over_cap="null").alias("open_price"),
        needs_custom_price(units).alias("needs_custom_price"),
    )


def token_costs(spark: SparkSession, sf: str) -> DataFrame:
    cost = token_cost(F.col("prompt_tokens"), F.col("completion_tokens"))
    return data.tokens(spark, sf).usage.select(
        "usage_id", F.round(cost, 6).cast("decimal(18,6)").alias("cost_eur")
    )


# --- composed queries -------------------------------------------------------------------------


def invoice(spark: SparkSession, sf: str) -> DataFrame:
    summary = use.usage_summary(data.usage(spark, sf), data.PRICING, data.MONTH)
    return use.invoice_lines(summary, data.PRICING)


def refreshed_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days from a stored grain: built on the tables as they were, then brought up to date."""
    root = new_dir(spark, "usage-grain")
    stored.build_grain(data.stamped_usage(spark, sf, earlier=True), root)
    now = data.stamped_usage(spark, sf, earlier=False)
    stored.refresh_grain(now, root)
    return use.daily_volume(replace(now, grain=stored.read_grain(now, root)))


def _stored_tokens(spark: SparkSession, sf: str) -> TokenTables:
    """The monthly calls as a stored grain."""
    t, path = data.monthly_tokens(spark, sf), new_dir(spark, "token-grain")
    tok.token_grain(t).write.parquet(path)
    return replace(t, grain=spark.read.parquet(path))


def estimated_records(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of the stored grain beside those of the calls: sums agree, records within five standard errors."""
    keys = ["client_name", "month"]
    exact = tok.llm_cost_by_client_month(data.monthly_tokens(spark, sf))
    stored_ = tok.llm_cost_by_client_month(_stored_tokens(spark, sf))
    both = exact.join(stored_.withColumnsRenamed({c: f"{c}_" for c in stored_.columns if c not in keys}), keys)
    apart = F.abs(F.col("records_processed_") - F.col("records_processed"))
    return both.select(
        *keys,
        "records_processed",
        F.col("llm_calls_").alias("llm_calls"),
        F.col("total_cost_eur_").alias("total_cost_eur"),
        (apart <= 5 * standard_error() * F.col("records_processed") + 1).alias("within"),
    )


def released_invoice(spark: SparkSession, sf: str) -> DataFrame:
    """What became of all items when the invoice was released."""
    root = new_dir(spark, "invoice")
    reconcile.release_invoice(data.usage(spark, sf), root, data.PRICING, data.MONTH)
    return read_bundle(spark, root)["counts"]


def bundled_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Two reports written as a bundle and read back through its manifest."""
    root = new_dir(spark, "bundle")
    usage, records = data.usage(spark, sf), data.records(spark, sf)
    report_bundle({"usage": use.usage_summary(usage, data.PRICING), "records": rec.client_daily_volume(records)}, root)
    found = read_bundle(spark, root)
    users = found["usage"].select(F.lit("usage").alias("report"), F.col("user_name").alias("name"), F.col("billable_items").alias("units"))
    per_client = found["records"].groupBy("client_name").agg(F.sum("records_created").alias("units"))
    return users.union(per_client.select(F.lit("records"), "client_name", "units"))


def read_and_unread(spark: SparkSession, sf: str) -> DataFrame:
    """Landed reports that were read, and those that were not by the reason."""
    path = data.landed_reports(spark, sf)
    bad = unreadable_sprint_reports(spark, path).groupBy("reason").agg(F.count(F.lit(1)).alias("reports"))
    good = read_sprint_reports(spark, path).agg(F.count("sprintId").alias("reports"))
    return bad.union(good.select(F.lit("read"), "reports"))


def revenue_pareto(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("revenue")
    revenue = data.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(amount)
    return amount_pareto(revenue, "user_id", "revenue")


def selected_sprints(spark: SparkSession, sf: str) -> DataFrame:
    return spr.select_sprints(data.sprint_months(spark, sf), prefix="Team 199", last_n=30)


def flat_reports(spark: SparkSession, sf: str, issues: str = "1") -> DataFrame:
    sprints = spr.select_sprints(data.sprint_months(spark, sf))
    reports = data.nested_reports(spark, sf, issues)
    rows = spr.flatten_sprint_reports(reports, sprints, data.BASE_URL)
    return rows.withColumn("sprint_end", F.to_date("sprint_end"))


def team(spark: SparkSession, sf: str) -> DataFrame:
    carried = spr.carryover_rows(data.sprint_issues(spark, sf))
    return spr.team_trend(carried, spr.select_sprints(data.sprint_months(spark, sf)))


def last_comments(spark: SparkSession, sf: str) -> DataFrame:
    turns = data.table(spark, sf, "conversations")
    return tic.last_comment_of(turns, "conv_id", "turn", "text", "role")


def document_texts(spark: SparkSession, sf: str) -> DataFrame:
    trees = data.document_trees(spark, sf)
    return trees.select("conv_id", "turn", tic.document_text(F.col("body")).alias("plain"))


def deep_document_texts(spark: SparkSession, sf: str) -> DataFrame:
    trees = data.deep_trees(spark, sf)
    return trees.select("conv_id", tic.document_text(F.col("body")).alias("plain"))


def sla_rows(spark: SparkSession, sf: str) -> DataFrame:
    status = tic.sla_status(F.col("sla"))
    return data.sla_cycles(spark, sf).select(
        "key", *[value.alias(name) for name, value in status.items()]
    )


def priorities_in_order(spark: SparkSession, sf: str) -> DataFrame:
    features = data.flat_tickets(spark, sf)
    return tic.ordered_priority(tic.count_by(features, "priority"))


def export(spark: SparkSession, sf: str, open_only: bool = False) -> DataFrame:
    features = data.ticket_features_of(spark, sf)
    return tic.ticket_export(features, list(data.SLA_FIELDS.values()), open_only)


def trend_of_top(spark: SparkSession, sf: str) -> DataFrame:
    carried = spr.carryover_rows(data.sprint_issues(spark, sf))
    return spr.carryover_trend(spr.carryover_matrix(carried, SPRINTS), SPRINTS, 10)


def odd_sprints(spark: SparkSession, sf: str) -> DataFrame:
    """Sprints whose names have a dot, a comma, a quote and a backtick."""
    issues = data.sprint_issues(spark, sf)
    name = F.concat(F.lit(data.ODD_PREFIX), F.year("sprint_end").cast("string"))
    carried = spr.carryover_rows(issues.withColumn("sprint_name", name))
    return spr.carryover_matrix(carried, data.odd_sprint_names())


QUERIES: dict[str, Query] = {
    # usage billing
    "display_name": display_names,
    "billable_units": _usage(use.billable_units),
    "usage_summary": _usage(use.usage_summary, data.PRICING),
    "usage_summary_month": _usage(use.usage_summary, data.PRICING, data.MONTH),
    "usage_summary_by_id": lambda s, sf: use.usage_summary(data.namesakes(s, sf), data.PRICING),
    "invoice_lines": invoice,
    "mom_growth": _usage(use.mom_growth, data.PRICING),
    "mom_growth_calendar": _usage(use.mom_growth, data.PRICING, calendar=True),
    "growth_matrix": lambda s, sf: use.growth_matrix(
        use.mom_growth(data.usage(s, sf), data.PRICING), MONTHS
    ),
    "consumption_trend": _usage(use.consumption_trend, data.PRICING),
    "ytd_cumulative": _usage(use.ytd_cumulative, data.PRICING, year=1996),
    "ytd_cumulative_all_years": _usage(use.ytd_cumulative, data.PRICING),
    "daily_volume": _usage(use.daily_volume),
    "daily_volume_month": _usage(use.daily_volume, data.MONTH),
    "daily_volume_refreshed": refreshed_days,
    "invoice_reconciliation": released_invoice,
    "report_bundle": bundled_reports,
    "daily_matrix": lambda s, sf: use.daily_matrix(
        use.daily_volume(data.usage(s, sf), data.MONTH), data.MONTH.days()
    ),
    "batch_efficiency": _usage(use.batch_efficiency),
    "usage_pareto": _usage(use.usage_pareto),
    "revenue_pareto": revenue_pareto,
    "status_distribution": _usage(use.status_distribution),
    "status_distribution_month": _usage(use.status_distribution, data.MONTH),
    "status_matrix": lambda s, sf: use.status_matrix(
        use.status_distribution(data.usage(s, sf)), data.STATUS_NAMES
    ),
    "match_quality": _usage(use.match_quality),
    "quality_matrix_pair_rate": lambda s, sf: use.quality_matrix(
        use.match_quality(data.usage(s, sf)), "pair_rate_pct", MONTHS
    ),
    "quality_matrix_no_match_rate": lambda s, sf: use.quality_matrix(
        use.match_quality(data.usage(s, sf)), "no_match_rate_pct", MONTHS
    ),
    "state_funnel": _usage(use.state_funnel),
    "funnel_matrix": lambda s, sf: use.funnel_matrix(
        use.state_funnel(data.usage(s, sf)), list(CASE_STATES.values())
    ),
    "settled_rate": lambda s, sf: use.settled_rate(use.state_funnel(data.usage(s, sf))),
    "stage_latency": lambda s, sf: use.stage_latency(data.latency(s, sf)),
    "candidate_depth": lambda s, sf: use.candidate_depth(data.offers(s, sf)),
    "candidate_depth_grouped": lambda s, sf: use.candidate_depth(data.offers_of_grouped_items(s, sf)),
    "attach_rate_fanned": lambda s, sf: use.attach_rate(data.fanned_accessories(s, sf)),
    "attach_rate": lambda s, sf: use.attach_rate(data.accessories(s, sf)),
    "volume_band": _usage(use.volume_band, data.PRICING),
    # document billing
    "tiered_price": tiered_prices,
    "billable_records": _records(rec.billable_records),
    "client_invoice": _records(rec.client_invoice),
    "client_invoice_month": _records(rec.client_invoice, 1996, 3),
    "client_mom_growth": _records(rec.client_mom_growth),
    "client_revenue_dated": lambda s, sf: rec.dated_revenue(data.records(s, sf), data.dated_prices(s)),
    "client_daily_volume": _records(rec.client_daily_volume),
    "client_revenue_trend": _records(rec.client_revenue_trend),
    "segment_revenue_trend": lambda s, sf: rec.client_revenue_trend(data.segment_records(s, sf), "year"),
    "segment_ytd_revenue": lambda s, sf: rec.ytd_revenue(
        data.segment_records(s, sf), "year", over_cap="null"
    ),
    "client_state_distribution": _records(rec.client_state_distribution),
    "job_efficiency": _records(rec.job_efficiency),
    "ytd_revenue": _records(rec.ytd_revenue),
    "tier_distribution": _records(rec.tier_distribution),
    "tier_distribution_yearly": _records(rec.tier_distribution, "year"),
    "client_pareto": _records(rec.client_pareto),
    "unbilled_records": _records(rec.unbilled_records),
    "duplicate_rate": _records(rec.duplicate_rate, "source_key"),
    "error_rate": _records(rec.error_rate, [7]),
    # model usage
    "token_cost": token_costs,
    "llm_cost_by_client_month": _monthly_tokens(tok.llm_cost_by_client_month),
    "llm_latency_by_client": _tokens(tok.llm_latency_by_client),
    "token_efficiency": _monthly_tokens(tok.token_efficiency),
    "calls_per_record": _tokens(tok.calls_per_record),
    "model_usage_monthly": _monthly_tokens(tok.model_usage_monthly),
    "llm_daily_volume": _tokens(tok.llm_daily_volume),
    "slowest_calls": _tokens(tok.slowest_calls, 50),
    "llm_cost_trend": _monthly_tokens(tok.llm_cost_trend),
    "llm_cost_trend_of_grain": lambda s, sf: tok.llm_cost_trend(_stored_tokens(s, sf)),
    "llm_records_estimated": estimated_records,
    # sprint carry-over
    "select_sprints": selected_sprints,
    "select_sprints_year": lambda s, sf: spr.select_sprints(data.sprint_months(s, sf), year=1997),
    "unreadable_reports": read_and_unread,
    "flatten_sprint_reports": flat_reports,
    "flatten_sprint_reports_long": lambda s, sf: flat_reports(s, sf, "1 + l_linenumber % 3"),
    "carryover_rows": _issues(lambda issues: spr.carryover_rows(issues, count_punted=True)),
    "carryover_matrix": _carried(lambda rows: spr.carryover_matrix(rows, SPRINTS)),
    "carryover_matrix_odd_names": odd_sprints,
    "carryover_trend": trend_of_top,
    "team_trend": team,
    "tickets_for": _issues(lambda issues: spr.tickets_for(issues, PERSON, count_punted=True)),
    "repeat_offenders": _carried(spr.repeat_offenders),
    "carryover_rate": _issues(lambda issues: spr.carryover_rate(issues, SPRINTS)),
    "bucket_counts": _issues(spr.bucket_counts),
    "bucket_counts_per_sprint": _issues(lambda i: spr.bucket_counts(i, per_sprint=True)),
    # service-desk tickets
    "flatten_tickets": data.ticket_rows,
    "last_comment": last_comments,
    "document_text": document_texts,
    "document_text_deep": deep_document_texts,
    "sla_status": sla_rows,
    "ticket_features": lambda s, sf: data.stamped_tickets(s, sf).select(
        "key", "created", "resolutiondate", "age_days", "resolution_days", "month", "week", "is_open"
    ),
    "ticket_kpis": _tickets(tic.ticket_kpis),
    "ticket_kpis_of_documents": lambda s, sf: tic.ticket_kpis(data.ticket_features_of(s, sf)),
    "count_by_status": _tickets(tic.count_by, "status"),
    "count_by_type": _tickets(tic.count_by, "issuetype"),
    "count_by_priority": _tickets(tic.count_by, "priority"),
    "monthly_volume": _tickets(tic.monthly_volume),
    "ordered_priority": priorities_in_order,
    "assignee_workload": _tickets(tic.assignee_workload),
    "top_reporters": _tickets(tic.top_reporters, 20),
    "aging_buckets": _tickets(tic.aging_buckets),
    "aging_by_assignee": _tickets(tic.aging_by_assignee),
    "oldest_open": _tickets(tic.oldest_open, 20),
    "resolution_stats": _tickets(tic.resolution_stats),
    "resolution_histogram": _tickets(tic.resolution_histogram),
    "median_resolution_by_type": _tickets(tic.median_resolution_by_type),
    "month_category_matrix": _tickets(
        tic.month_category_matrix, ["To Do", "In Progress", "Done"]
    ),
    "ticket_export": export,
    "ticket_export_open": lambda s, sf: export(s, sf, open_only=True),
}
