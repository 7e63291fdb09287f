"""Usage billing on the hierarchy user -> case -> item -> offer -> accessory.

The item table is by far the largest. Every report therefore reduces it before it meets another
table: items fold to one row per case (map-side first, so a case with a third of all items is
one row per task when it is shuffled), then join the case table on a key both sides already
share, fold to (user id, period), and only then pick up names. A case has one user and one
creation time, so "distinct cases" becomes a plain count and no report needs a distinct
aggregation over items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.bindings import Period, Pricing, UsageTables
from abacist.functions import (
    amount,
    band,
    day_of,
    display_name,
    exchange,
    growth,
    grouped_quantiles,
    join_on_group,
    month_of,
    numeric,
    pct,
    ratio,
    seconds_between,
    sketch,
    sketch_quantile,
)
from abacist.functions.columns import UNKNOWN_USER
from abacist.operators.matrix import day_label, matrix, month_label, pareto, running_sum

# Item statuses and case states.
ITEM_STATUSES = {1: "CREATED", 2: "MATCHED", 3: "NOT_MATCHED", 4: "MATCH_NOT_FOUND", 5: "PAIRED"}
CASE_STATES = {
    1: "OPENED",
    2: "PARSED",
    3: "NOT_PARSED",
    4: "FAILED",
    5: "PROCESSED",
    6: "EXPORTED",
    7: "NOT_EXPORTED",
    8: "DROPPED",
}

# Invoice footer labels and the label of users without a role.
SUBTOTAL_LINE = "ZZ SUBTOTAL (items)"
FEE_LINE = "ZZ AZURE INFRA FEE"
TOTAL_LINE = "ZZ TOTAL"
NO_ROLE = "(none)"

# Descriptive monthly volume bands, upper bounds inclusive.
VOLUME_EDGES = (500, 1000, 1500, 2000, 3000, 5000)
VOLUME_LABELS = (
    "0–500",
    "501–1000",
    "1001–1500",
    "1501–2000",
    "2001–3000",
    "3001–5000",
    "5000+",
)


# --- shared pieces ----------------------------------------------------------------------------


def kept_cases(t: UsageTables, period: Period | None = None) -> DataFrame:
    """Cases after the period, exclusion and deletion rules; all predicates reach the scan."""
    cases, rules = t.case, t.rules
    if period is not None:
        cases = cases.where(period.contains(F.col("created_at")))
    if not rules.include_deleted:
        cases = cases.where(~F.col("is_deleted"))
    if isinstance(rules.excluded_users, DataFrame):
        # an anti join keeps cases without a user, as the literal form below does
        cases = cases.join(rules.excluded_users.select("user_id"), "user_id", "left_anti")
    elif rules.excluded_users:
        user = F.col("user_id")
        cases = cases.where(user.isNull() | ~user.isin(*rules.excluded_users))
    return cases


def kept_items(
    t: UsageTables, billable_only: bool = True, period: Period | None = None
) -> DataFrame:
    """Items after the status and deletion rules; of a period as far as the table knows it."""
    items = t.case_item
    if period is not None and "case_created_at" in items.columns:
        items = items.where(period.contains(F.col("case_created_at")))
    if billable_only:
        items = items.where(F.col("status_id").isin(*t.rules.billable))
    if not t.rules.include_deleted:
        items = items.where(~F.col("is_deleted"))
    return items


def with_user(df: DataFrame, t: UsageTables, role: bool = False) -> DataFrame:
    """Replace ``user_id`` by ``user_name`` (and ``role_name``).

    Users and roles join each other first, so the rows in ``df`` go through one join only.
    """
    name = display_name(F.col("first_name"), F.col("last_name"), F.col("email"))
    users = t.user.select("user_id", name.alias("user_name"), *(["role_id"] if role else []))
    fallback = {"user_name": UNKNOWN_USER}
    if role:
        users = users.join(t.user_role.select("role_id", "role_name"), "role_id", "left")
        fallback["role_name"] = NO_ROLE
    named = df.join(users, "user_id", "left")
    rest = [c for c in df.columns if c != "user_id" or t.rules.by_user_id]
    return named.select(*[F.coalesce(c, F.lit(x)).alias(c) for c, x in fallback.items()], *rest)


def entity(t: UsageTables) -> list[str]:
    """The columns that tell users apart."""
    return ["user_id", "user_name"] if t.rules.by_user_id else ["user_name"]


def case_folds(
    t: UsageTables,
    measures: dict[str, Column],
    period: Period | None = None,
    billable_only: bool = True,
) -> DataFrame:
    """One row per kept case that has items: ``user_id``, ``created_at`` and item measures."""
    per_case = kept_items(t, billable_only, period).groupBy("case_id").agg(
        *[m.alias(name) for name, m in measures.items()]
    )
    cases = kept_cases(t, period).select("case_id", "user_id", "created_at")
    return cases.join(per_case, "case_id")


def _sums(names: Sequence[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _by_user(
    t: UsageTables, folds: DataFrame, by: dict[str, Column], measures: Sequence[str], role=False
) -> DataFrame:
    """Fold to (user id, ``by``), attach names, fold again because names can coincide."""
    grain = folds.groupBy("user_id", *[c.alias(n) for n, c in by.items()]).agg(*_sums(measures))
    keys = [*entity(t), *(["role_name"] if role else []), *by]
    return with_user(grain, t, role).groupBy(*keys).agg(*_sums(measures))


_GRAIN_MEASURES = ["cases", "billable_items"]


def _counted(t: UsageTables, period: Period | None) -> tuple[DataFrame, Column]:
    """Rows with ``cases`` and ``billable_items`` and their time: stored days or single cases."""
    if t.grain is not None:
        day = F.col("day")
        return (t.grain if period is None else t.grain.where(period.contains(day))), day
    folds = case_folds(t, {"billable_items": F.count("item_id")}, period)
    return folds.withColumn("cases", F.lit(1).cast("bigint")), F.col("created_at")


def usage_grain(
    t: UsageTables,
    period: Period | None = None,
    by: str | None = None,
    role: bool = False,
) -> DataFrame:
    """Cases and billable items per user (and role), per ``month`` or ``day`` if asked."""
    source, at = _counted(t, period)
    time = {None: {}, "month": {"month": month_of(at)}, "day": {"day": day_of(at)}}[by]
    if t.grain is not None:
        keys = [*entity(t), *(["role_name"] if role else [])]
        times = [c.alias(n) for n, c in time.items()]
        return source.groupBy(*keys, *times).agg(*_sums(_GRAIN_MEASURES))
    return _by_user(t, source, time, _GRAIN_MEASURES, role)


def daily_grain(t: UsageTables) -> DataFrame:
    """The base to store once for several reports: usage per user, role and day.

    A case has one user and one creation time, so case counts add up over days as items do.
    """
    return usage_grain(t, by="day", role=True)


# --- operators --------------------------------------------------------------------------------


def billable_units(t: UsageTables, period: Period | None = None) -> DataFrame:
    """Row-level base: every billable item with its case, user and role."""
    cases = kept_cases(t, period).select("case_id", "user_id", "created_at")
    named = with_user(cases, t, role=True)
    items = kept_items(t, period=period).select("case_id", "item_id", "status_id")
    return items.join(named, "case_id").select(
        "case_id", "item_id", "status_id", "created_at", "user_name", "role_name"
    )


def usage_summary(
    t: UsageTables, pricing: Pricing = Pricing(), period: Period | None = None
) -> DataFrame:
    """Cases, units and amount per user and role, with the amount in both currencies."""
    return _priced(usage_grain(t, period, role=True), pricing)


def _priced(df: DataFrame, pricing: Pricing) -> DataFrame:
    """Add the amount and its exchange value, which is taken from the rounded amount."""
    priced = df.withColumn("amount_eur", amount(F.col("billable_items"), pricing.unit_price))
    return priced.withColumn("amount_czk", exchange(F.col("amount_eur"), pricing.fx))


def invoice_lines(summary: DataFrame, pricing: Pricing = Pricing()) -> DataFrame:
    """Detail lines plus subtotal, fixed fee and total.

    The subtotal is priced from the raw count, not from the rounded lines, and the fee is
    charged once. ``line_order`` puts the footer lines in sequence after the details.
    """
    units, fee = F.col("billable_items"), F.lit(pricing.fee).cast("decimal(18,2)")
    items_eur = amount(units, pricing.unit_price)
    by_id = "user_id" in summary.columns

    def line(order: int, name: str, cases: Column, items: Column, eur: Column) -> Column:
        return F.struct(
            F.lit(order).alias("line_order"),
            *([F.lit(None).cast(summary.schema["user_id"].dataType).alias("user_id")] if by_id else []),
            F.lit(name).alias("user_name"),
            F.lit("").alias("role_name"),
            cases.cast("bigint").alias("cases"),
            items.cast("bigint").alias("billable_items"),
            eur.cast("decimal(18,2)").alias("amount_eur"),
        )

    none = F.lit(None)
    footer = (
        summary.agg(
            F.coalesce(F.sum("cases"), F.lit(0)).alias("cases"),
            F.coalesce(F.sum("billable_items"), F.lit(0)).alias("billable_items"),
        )
        .select(
            F.inline(
                F.array(
                    line(1, SUBTOTAL_LINE, F.col("cases"), units, items_eur),
                    line(2, FEE_LINE, none, none, fee),
                    line(3, TOTAL_LINE, F.col("cases"), units, items_eur + fee),
                )
            )
        )
        .withColumn("amount_czk", exchange(F.col("amount_eur"), pricing.fx))
    )
    details = summary.withColumn("line_order", F.lit(0))
    return details.unionByName(footer)


def month_spine(df: DataFrame, entity: Sequence[str], time: str = "month") -> DataFrame:
    """Every calendar month between an entity's first and last one."""
    span = df.groupBy(*entity).agg(F.min(time).alias("_from"), F.max(time).alias("_to"))
    months = F.sequence("_from", "_to", F.expr("interval 1 month"))
    return span.select(*entity, F.explode(months).alias(time))


def _with_gaps(df: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Add the months an entity has no row for, with zeros; its own rows stay as they are."""
    keys = [*entity, "month"]
    found = df.where(F.col("month").isNotNull()).withColumn("_found", F.lit(True))
    dense = join_on_group(month_spine(df, entity), found, keys, "left")
    measures = [c for c in df.columns if c not in keys]
    empty = {c: F.lit(0).cast(df.schema[c].dataType) for c in measures}
    return dense.select(
        *keys, *[F.when(F.col("_found"), F.col(c)).otherwise(empty[c]).alias(c) for c in measures]
    )


def with_growth(
    df: DataFrame, entity: Sequence[str], measures: dict[str, tuple[str, str]], calendar: bool = False
) -> DataFrame:
    """Add the previous month's value and the growth in percent for each measure.

    ``measures`` maps a column to the names of its previous-value and growth columns. The
    previous month is the previous one *present*; ``calendar`` takes the calendar month before,
    counting a missing one as zero.
    """
    if calendar:
        df = _with_gaps(df, entity)
    ordered = Window.partitionBy(*entity).orderBy("month")
    previous = df.select(
        "*", *[F.lag(c).over(ordered).alias(prev) for c, (prev, _) in measures.items()]
    )
    return previous.select(
        "*", *[growth(F.col(c), F.col(prev)).alias(g) for c, (prev, g) in measures.items()]
    )


def mom_growth(
    t: UsageTables, pricing: Pricing = Pricing(), calendar: bool = False
) -> DataFrame:
    """Monthly usage per user with the change against the previous month."""
    monthly = _priced(usage_grain(t, by="month"), pricing).drop("amount_czk")
    grown = with_growth(
        monthly,
        entity(t),
        {
            "billable_items": ("prev_month_items", "items_growth_pct"),
            "amount_eur": ("prev_month_amount_eur", "revenue_growth_pct"),
        },
        calendar,
    )
    return grown


def _row_of(report: DataFrame) -> list[str]:
    return [c for c in ("user_id", "user_name") if c in report.columns]


def growth_matrix(grown: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """User x month matrix of item growth; ``months`` has to list every month that occurs."""
    cell = F.first("items_growth_pct", ignorenulls=True)
    return matrix(grown, _row_of(grown), month_label("month"), cell, months)


def consumption_trend(t: UsageTables, pricing: Pricing = Pricing()) -> DataFrame:
    """Monthly cases, units and amounts per user."""
    return _priced(usage_grain(t, by="month"), pricing)


def ytd_cumulative(
    t: UsageTables, pricing: Pricing = Pricing(), year: int | None = None
) -> DataFrame:
    """Monthly charge with the fixed fee and running totals; all years without ``year``."""
    period = Period.year(year) if year is not None else None
    source, at = _counted(t, period)
    monthly = (
        source.groupBy(month_of(at).alias("month"))
        .agg(F.sum("billable_items").alias("billable_items"))
        .withColumn("items_amount_eur", amount(F.col("billable_items"), pricing.unit_price))
        .withColumn("azure_fee_eur", F.lit(pricing.fee).cast("decimal(18,2)"))
        .withColumn(
            "total_eur", (F.col("items_amount_eur") + F.col("azure_fee_eur")).cast("decimal(18,2)")
        )
        .withColumn("total_czk", exchange(F.col("total_eur"), pricing.fx))
    )
    return monthly.select(
        "*",
        running_sum("billable_items", "month").alias("cumulative_items"),
        running_sum("total_eur", "month").cast("decimal(18,2)").alias("cumulative_eur"),
        running_sum("total_czk", "month").cast("decimal(18,2)").alias("cumulative_czk"),
    )


def daily_volume(t: UsageTables, period: Period | None = None) -> DataFrame:
    """Cases and units per user and day."""
    return usage_grain(t, period, by="day")


def daily_matrix(daily: DataFrame, days: Sequence[str] | None = None) -> DataFrame:
    """User x day-of-month units, zero for gaps; without ``days`` only days that occur."""
    cell = F.sum("billable_items")
    return matrix(daily, _row_of(daily), day_label("day"), cell, days, 0)


def batch_efficiency(t: UsageTables) -> DataFrame:
    """Distribution of items per case for each user, weighted by case.

    Cases fold to a histogram of case sizes per user first. Few sizes differ (fewer than
    sqrt(2 N) for N items), so the exact percentile runs on a small weighted map.
    """
    sizes = (
        case_folds(t, {"size": F.count("item_id")})
        .groupBy("user_id", "size")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    size, n = F.col("size"), F.col("n")
    stats = with_user(sizes, t).groupBy(*entity(t)).agg(
        F.sum(n).alias("cases"),
        F.sum(size * n).alias("billable_items"),
        F.min(size).alias("smallest_case"),
        F.max(size).alias("largest_case"),
        F.percentile(size, F.array(F.lit(0.5), F.lit(0.95)), n).alias("_p"),
    )
    return stats.select(
        *entity(t),
        "cases",
        "billable_items",
        ratio(F.col("billable_items"), F.col("cases"), 1).alias("items_per_case"),
        "smallest_case",
        "largest_case",
        numeric(F.col("_p")[0], 1).alias("median_case_size"),
        numeric(F.col("_p")[1], 1).alias("p95_case_size"),
    )


def usage_pareto(t: UsageTables) -> DataFrame:
    """Users by volume with their share and cumulative share."""
    volumes = usage_grain(t).select(*entity(t), "billable_items")
    return pareto(volumes, entity(t), "billable_items")


def status_distribution(t: UsageTables, period: Period | None = None) -> DataFrame:
    """Items per user and status with the share inside the user.

    Whatever status of the status table occurs is listed; items of other statuses do not count.
    Items fold to one row per case and status first.
    """
    per_case = (
        kept_items(t, False, period)
        .groupBy("case_id", "status_id")
        .agg(F.count(F.lit(1)).alias("item_count"))
    )
    cases = kept_cases(t, period).select("case_id", "user_id")
    counted = _by_user(
        t, cases.join(per_case, "case_id"), {"status_id": F.col("status_id")}, ["item_count"]
    )
    long = counted.join(t.item_status.select("status_id", "status_name"), "status_id")
    of_user = F.sum("item_count").over(Window.partitionBy(*entity(t)))
    return long.select(
        *entity(t),
        "status_id",
        "status_name",
        F.col("status_id").isin(*t.rules.billable).alias("is_billable"),
        "item_count",
        pct(F.col("item_count"), of_user).alias("pct_of_user"),
    )


def status_matrix(distribution: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """User x status counts, zero-filled."""
    cell = F.sum("item_count")
    return matrix(distribution, _row_of(distribution), "status_name", cell, names, 0)


def match_quality(t: UsageTables) -> DataFrame:
    """Monthly outcome counts per user and three rates on the billable count.

    The exact-dimension count is not limited to billable items, so its rate can exceed 100.
    """
    status = F.col("status_id")
    counts = {
        "billable_items": F.count_if(status.isin(*t.rules.billable)),
        "paired": F.count_if(status == 5),
        "matched_not_paired": F.count_if(status == 2),
        "match_not_found": F.count_if(status == 4),
        "not_matched_unbilled": F.count_if(status == 3),
        "still_created_unbilled": F.count_if(status == 1),
        "_exact": F.count_if("exact_dimensions_found"),
    }
    folds = case_folds(t, counts, billable_only=False)
    monthly = _by_user(t, folds, {"month": month_of(F.col("created_at"))}, list(counts))
    billable = F.col("billable_items")
    return monthly.select(
        *entity(t),
        "month",
        *[c for c in counts if c != "_exact"],
        pct(F.col("paired"), billable).alias("pair_rate_pct"),
        pct(F.col("match_not_found"), billable).alias("no_match_rate_pct"),
        pct(F.col("_exact"), billable).alias("exact_dimensions_pct"),
    )


def quality_matrix(
    quality: DataFrame, metric: str = "pair_rate_pct", months: Sequence[str] | None = None
) -> DataFrame:
    """User x month matrix of one rate; users without any value are left out."""
    known = quality.where(F.col(metric).isNotNull())
    cell = F.first(metric)
    return matrix(known, _row_of(known), month_label("month"), cell, months)


def state_funnel(t: UsageTables) -> DataFrame:
    """Cases per month and state. "Settled" is a state band, it includes failures."""
    counted = (
        kept_cases(t)
        .groupBy(month_of(F.col("created_at")).alias("month"), "state_id")
        .agg(
            F.count(F.lit(1)).alias("cases"),
            F.sum("items_total").alias("items_total"),
            numeric(F.avg("percentage_matched"), 1).alias("avg_pct_matched"),
            numeric(F.avg("percentage_done"), 1).alias("avg_pct_done"),
        )
        .join(t.case_state.select("state_id", "state_name"), "state_id")
    )
    of_month = F.sum("cases").over(Window.partitionBy("month"))
    return counted.select(
        "month",
        "state_id",
        "state_name",
        (F.col("state_id") >= t.rules.settled_min_state).alias("is_settled"),
        "cases",
        pct(F.col("cases"), of_month).alias("pct_of_month"),
        "items_total",
        "avg_pct_matched",
        "avg_pct_done",
    )


def funnel_matrix(funnel: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Month x state counts, zero-filled."""
    labelled = funnel.withColumn("month", month_label("month"))
    return matrix(labelled, ["month"], "state_name", F.sum("cases"), names, 0)


def settled_rate(funnel: DataFrame) -> DataFrame:
    """Settled share of each month's cases."""
    settled = F.coalesce(F.sum(F.when(F.col("is_settled"), F.col("cases"))), F.lit(0))
    share = F.lit(100.0) * settled / F.greatest(F.sum("cases"), F.lit(1))
    return funnel.groupBy("month").agg(share.alias("settled_pct"))


def stage_latency(t: UsageTables, exact: bool = True) -> DataFrame:
    """Mean and percentile seconds of the two processing stages per month.

    Percentiles are exact; without ``exact`` they are those of the sketch, in a single pass.
    """
    cases = kept_cases(t).where(
        F.col("queued_at").isNotNull() & (F.col("state_id") >= t.rules.settled_min_state)
    )
    spans = cases.select(
        month_of(F.col("created_at")).alias("month"),
        seconds_between(F.col("queued_at"), F.col("created_at")).alias("parse"),
        seconds_between(F.col("last_modified"), F.col("queued_at")).alias("process"),
        "items_total",
    )
    stages, quantiles = ["parse", "process"], {"p50": "0.5", "p95": "0.95"}
    monthly = spans.groupBy("month").agg(
        F.count(F.lit(1)).alias("cases"),
        *[F.avg(s).alias(f"avg_{s}") for s in stages],
        F.sum("items_total").alias("_items"),
        F.count("items_total").alias("_sized"),
        *[c for s in stages for c in sketch(s, name=s)],
    )
    if not exact:
        monthly = monthly.withColumns(
            {f"{q}_{s}": sketch_quantile(p, s) for s in stages for q, p in quantiles.items()}
        )
    else:
        long = spans.select(
            "month",
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(s).alias("stage"), F.col(s).alias("seconds"))
                        for s in stages
                    ]
                )
            ),
        )
        sketches = [
            F.struct(F.lit(s).alias("stage"), F.col(f"_sketch{s}").alias("_sketch")) for s in stages
        ]
        # calendar months x 2 stages: a bracket table of fixed size
        selected = grouped_quantiles(
            long,
            ["month", "stage"],
            "seconds",
            quantiles,
            sketches=monthly.select("month", F.inline(F.array(*sketches))),
            few_groups=True,
        )
        wide = selected.groupBy("month").agg(
            *[
                F.max(F.when(F.col("stage") == s, F.col(q))).alias(f"{q}_{s}")
                for s in stages
                for q in quantiles
            ]
        )
        monthly = join_on_group(monthly, wide, ["month"], "left")
    return monthly.select(
        "month",
        "cases",
        *[
            numeric(F.col(f"{stat}_{s}"), 1).alias(f"{stat}_{s}_secs")
            for s in stages
            for stat in ("avg", *quantiles)
        ],
        ratio(F.col("_items"), F.col("_sized"), 1).alias("avg_items_per_case"),
    )


def candidate_depth(t: UsageTables, exact: bool = True) -> DataFrame:
    """Offers per billable item and how often and how close one was selected.

    Offers fold to one row per item before they meet the items. The median of the selected
    distance is exact, by a second pass over the selected offers only; without ``exact`` it is the sketch's.
    """
    selected = F.col("is_selected")
    per_item = t.offer_item.groupBy("item_id").agg(
        F.count("offer_item_id").alias("offers"),
        F.count(F.when(selected, F.col("offer_item_id"))).alias("selected"),
        F.min("match_distance").alias("best"),
        F.min(F.when(selected, F.col("match_distance"))).alias("chosen"),
    )
    items = kept_items(t).select("item_id", "case_id")
    cases = kept_cases(t).select(
        "case_id", "user_id", month_of(F.col("created_at")).alias("month")
    )
    owners = with_user(cases, t)
    rows = items.join(per_item, "item_id", "left").join(owners, "case_id")
    keys = [*entity(t), "month"]
    median = "p50_selected_distance"
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("billable_items"),
        F.sum(F.coalesce("offers", F.lit(0))).alias("_offers"),
        F.count_if(F.coalesce("offers", F.lit(0)) == 0).alias("items_with_no_offer"),
        F.count_if(F.col("selected") > 0).alias("items_with_selection"),
        F.avg("best").alias("_best"),
        F.avg("chosen").alias("_chosen"),
        *sketch("chosen"),
    )
    if exact:
        chosen = t.offer_item.where(selected & F.col("match_distance").isNotNull())
        chosen = chosen.groupBy("item_id").agg(F.min("match_distance").alias("chosen"))
        chosen = items.join(chosen, "item_id").join(owners, "case_id")
        found = grouped_quantiles(
            chosen, keys, "chosen", {median: "0.5"}, sketches=stats, spread=["case_id"]
        )
        stats = join_on_group(stats, found, keys, "left")
    else:
        stats = stats.withColumn(median, sketch_quantile("0.5"))
    units = F.col("billable_items")
    return stats.select(
        *keys,
        "billable_items",
        ratio(F.col("_offers"), units, 2).alias("avg_offers_per_item"),
        "items_with_no_offer",
        "items_with_selection",
        pct(F.col("items_with_selection"), units).alias("selection_rate_pct"),
        numeric(F.col("_best"), 4).alias("avg_best_distance"),
        numeric(F.col("_chosen"), 4).alias("avg_selected_distance"),
        numeric(F.col(median), 4).alias(median),
    )


def attach_rate(t: UsageTables) -> DataFrame:
    """Accessories offered and selected on selected offers per month.

    Every level folds into its parent key before the next join: accessories to offers, offers to
    items, items to cases. An offer is then one row, so offers are counted without a distinct.
    """
    picked = F.col("is_selected")
    per_offer = t.product_accessory.groupBy("offer_item_id").agg(
        F.count("accessory_id").alias("offered"),
        F.count(F.when(picked, F.col("accessory_id"))).alias("picked"),
        F.sum(F.when(picked, F.col("accessory_quantity"))).alias("quantity"),
        F.max(picked.cast("bigint")).alias("with_accessory"),
    )
    measures = ["offers", "offered", "picked", "quantity", "with_accessory"]
    per_item = (
        t.offer_item.where(picked)
        .select("offer_item_id", "item_id", F.lit(1).cast("bigint").alias("offers"))
        .join(per_offer, "offer_item_id", "left")
        .groupBy("item_id")
        .agg(*_sums(measures))
    )
    per_case = (
        kept_items(t)
        .select("item_id", "case_id")
        .join(per_item, "item_id")
        .groupBy("case_id")
        .agg(*_sums(measures))
    )
    monthly = (
        kept_cases(t)
        .select("case_id", month_of(F.col("created_at")).alias("month"))
        .join(per_case, "case_id")
        .groupBy("month")
        .agg(*_sums(measures))
    )
    zero = F.lit(0)
    return monthly.select(
        "month",
        F.col("offers").alias("selected_offers"),
        F.coalesce("offered", zero).alias("accessories_offered"),
        F.coalesce("picked", zero).alias("accessories_selected"),
        F.col("quantity").alias("accessory_qty_selected"),
        pct(F.coalesce("with_accessory", zero), F.col("offers")).alias(
            "offers_with_accessory_pct"
        ),
    )


def volume_band(
    t: UsageTables,
    pricing: Pricing = Pricing(),
    edges: Sequence[int] = VOLUME_EDGES,
    labels: Sequence[str] = VOLUME_LABELS,
) -> DataFrame:
    """Monthly usage per user with a descriptive volume band."""
    monthly = _priced(usage_grain(t, by="month"), pricing).drop("amount_czk")
    banded = monthly.withColumn("volume_band", band(F.col("billable_items"), edges, labels))
    return banded
