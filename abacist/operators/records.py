"""Document billing with tiered monthly prices.

As in usage billing, records fold to (client id, period) before the client table is joined, so
the join and everything after it work on report-sized rows. Reports by month accept another
calendar ``grain`` (``year``, ``quarter``); the column keeps the name ``month``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.bindings import Period, RecordTables
from abacist.functions import band, day_of, interval_join, join_on_group, month_of, pct, ratio, tiered_price
from abacist.functions.columns import needs_custom_price
from abacist.operators.matrix import pareto, running_sum
from abacist.operators.usage import with_growth

# Total line label and pricing tier labels, upper bounds inclusive.
TOTAL_LINE = "ZZ TOTAL"
TIER_EDGES = (500, 1000, 1500, 2000, 3000, 5000)
TIER_LABELS = (
    "0–500 (10 Kč)",
    "501–1000 (9 Kč)",
    "1001–1500 (8 Kč)",
    "1501–2000 (7 Kč)",
    "2001–3000 (6 Kč)",
    "3001–5000 (5 Kč)",
    "5000+ (custom)",
)


def billable_state(state: Column) -> Column:
    """Fixed rule: harvested (18 and up) or closed early (12)."""
    return (state >= 18) | (state == 12)


Rule = Callable[[Column], Column]


def kept_records(
    t: RecordTables, billable: Rule | None = billable_state, period: Period | None = None
) -> DataFrame:
    """Records that are not deleted, in the period, and in a billable state if a rule is given."""
    records = t.record.where(~F.col("is_deleted"))
    if period is not None:
        records = records.where(period.contains(F.col("created_at")))
    if billable is not None:
        records = records.where(billable(F.col("state_id")))
    return records


def with_client(df: DataFrame, t, keep_unknown: bool = False) -> DataFrame:
    """Replace ``client_id`` by ``client_name``; rows of unknown clients are dropped."""
    clients = t.client.select("client_id", F.col("name").alias("client_name"))
    named = df.join(clients, "client_id", "left" if keep_unknown else "inner")
    return named.select(
        *client(t), *[c for c in df.columns if c not in ("client_id", "client_name")]
    )


def client(t) -> list[str]:
    """The columns that tell clients apart."""
    return ["client_id", "client_name"] if t.by_client_id else ["client_name"]


def record_grain(
    t: RecordTables,
    by: dict[str, Column] | None = None,
    billable: Rule | None = billable_state,
    period: Period | None = None,
) -> DataFrame:
    """Record count per client name and the ``by`` columns."""
    by = by or {}
    counted = (
        kept_records(t, billable, period)
        .groupBy("client_id", *[c.alias(n) for n, c in by.items()])
        .agg(F.count("record_id").alias("records_created"))
    )
    keys = [*client(t), *by]
    return with_client(counted, t).groupBy(*keys).agg(
        F.sum("records_created").alias("records_created")
    )


def _monthly(t: RecordTables, grain: str, billable: Rule) -> DataFrame:
    return record_grain(t, {"month": month_of(F.col("created_at"), grain)}, billable)


def _job_grain(t: RecordTables, billable: Rule, period: Period | None = None) -> DataFrame:
    """Distinct jobs and records per client: one row per job first, then a plain count."""
    per_job = (
        kept_records(t, billable, period)
        .groupBy("client_id", "job_harvest_id")
        .agg(F.count("record_id").alias("records_created"))
    )
    return with_client(per_job, t).groupBy(*client(t)).agg(
        F.countDistinct("job_harvest_id").alias("jobs_harvested"),
        F.sum("records_created").alias("records_created"),
    )


def billable_records(
    t: RecordTables, billable: Rule = billable_state, period: Period | None = None
) -> DataFrame:
    """Row-level base: billable records with their client."""
    records = kept_records(t, billable, period)
    return with_client(
        records.select("client_id", "record_id", "job_harvest_id", "state_id", "created_at"), t
    )


def client_invoice(
    t: RecordTables,
    year: int | None = None,
    month: int | None = None,
    billable: Rule = billable_state,
    over_cap: str = "minimum",
) -> DataFrame:
    """Jobs, records and price per client and a grand total.

    Above the last tier there is no list price: the floor is billed (``over_cap='null'`` leaves
    it open) and ``needs_custom_price`` marks the line.
    """
    period = None
    if year is not None:
        period = Period.month(year, month) if month is not None else Period.year(year)
    units = F.col("records_created")
    lines = _job_grain(t, billable, period).select(
        *client(t),
        "jobs_harvested",
        "records_created",
        tiered_price(units, over_cap=over_cap).alias("monthly_price_czk"),
        needs_custom_price(units).alias("needs_custom_price"),
    )
    total = lines.agg(
        *([F.lit(None).cast(lines.schema["client_id"].dataType).alias("client_id")] if t.by_client_id else []),
        F.lit(TOTAL_LINE).alias("client_name"),
        F.sum("jobs_harvested").alias("jobs_harvested"),
        F.sum("records_created").alias("records_created"),
        F.sum("monthly_price_czk").alias("monthly_price_czk"),
        F.coalesce(F.bool_or("needs_custom_price"), F.lit(False)).alias("needs_custom_price"),
    )
    return lines.unionByName(total)


def dated_revenue(
    t: RecordTables, prices: DataFrame, grain: str = "month", billable: Rule = billable_state
) -> DataFrame:
    """Records and price per client and period, by price lists that change over time.

    ``prices`` has a row per bracket of a list: ``client_name`` (NULL for the list of all others), ``valid_from``
    and ``valid_to`` (dates, the second exclusive, NULL open), ``lower`` and ``upper`` (records, ``lower`` exclusive,
    a NULL ``upper`` open), ``rate`` per record and ``minimum`` of the list. The list valid on the first day of
    the period counts, a client's own before the general one; without any the price is NULL.
    """
    day = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    monthly = _monthly(t, grain, billable)
    units = monthly.select(
        *client(t), "month", "records_created", day("month").alias("_day"),
        F.explode(F.array(F.lit(True), F.lit(False))).alias("_own"),
    )
    units = units.withColumn("_list", F.when(F.col("_own"), F.col("client_name")))
    units = units.where(~F.col("_own") | F.col("client_name").isNotNull())
    listed = prices.select(
        F.col("client_name").alias("_list"), "lower", "upper", "rate", "minimum",
        day("valid_from").alias("_from"), day("valid_to").alias("_to"),
    )
    met = interval_join(units, listed, ["_list"], "_day", "_from", "_to")
    n = F.col("records_created")
    inside = F.greatest(F.least(n, F.coalesce("upper", n)) - F.col("lower"), F.lit(0))
    per_list = met.groupBy(*client(t), "month", "_own").agg(
        F.greatest(F.sum(inside * F.col("rate")), F.max("minimum")).cast("decimal(18,2)").alias("price")
    )
    best = per_list.groupBy(*client(t), "month").agg(F.max(F.struct("_own", "price")).alias("_best"))
    found = join_on_group(monthly, best, [*client(t), "month"], "left")
    return found.select(
        *client(t), "month", "records_created", F.col("_best.price").alias("price_czk"),
        F.col("_best._own").alias("own_list"),
    )


def client_mom_growth(
    t: RecordTables,
    grain: str = "month",
    billable: Rule = billable_state,
    calendar: bool = False,
    over_cap: str = "minimum",
) -> DataFrame:
    """Monthly records and price per client with the change against the previous month.

    For months above the last tier see ``client_invoice``.
    """
    return with_growth(
        client_revenue_trend(t, grain, billable, over_cap),
        client(t),
        {
            "records_created": ("prev_month_records", "records_growth_pct"),
            "monthly_price_czk": ("prev_month_price_czk", "revenue_growth_pct"),
        },
        calendar,
    )


def client_daily_volume(t: RecordTables, billable: Rule = billable_state) -> DataFrame:
    """Records per client and day."""
    return record_grain(t, {"day": day_of(F.col("created_at"))}, billable)


def client_revenue_trend(
    t: RecordTables,
    grain: str = "month",
    billable: Rule = billable_state,
    over_cap: str = "minimum",
) -> DataFrame:
    """Records and price per client and month; for ``over_cap`` see ``client_invoice``."""
    units = F.col("records_created")
    return _monthly(t, grain, billable).withColumns(
        {
            "monthly_price_czk": tiered_price(units, over_cap=over_cap),
            "needs_custom_price": needs_custom_price(units),
        }
    )


def client_state_distribution(t: RecordTables) -> DataFrame:
    """Non-deleted records per client and state with the share inside the client."""
    counted = (
        kept_records(t, None)
        .groupBy("client_id", "state_id")
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
    by_state = with_client(counted, t).groupBy(*client(t), "state_id").agg(
        F.sum("record_count").alias("record_count")
    )
    of_client = F.sum("record_count").over(Window.partitionBy(*client(t)))
    return by_state.withColumn("pct_of_client", pct(F.col("record_count"), of_client))


def job_efficiency(t: RecordTables, billable: Rule = billable_state) -> DataFrame:
    """Records per harvest job and client."""
    per_job = ratio(F.col("records_created"), F.col("jobs_harvested"), 1)
    return _job_grain(t, billable).withColumn("records_per_job", per_job)


def ytd_revenue(
    t: RecordTables,
    grain: str = "month",
    billable: Rule = billable_state,
    over_cap: str = "minimum",
) -> DataFrame:
    """Monthly revenue over all clients, priced per client, with a running total.

    ``needs_custom_price`` marks months in which a client is above the last tier, so that its
    revenue is the floor (or open, with ``over_cap='null'``).
    """
    revenue = (
        client_revenue_trend(t, grain, billable, over_cap)
        .groupBy("month")
        .agg(
            F.sum("monthly_price_czk").alias("monthly_revenue_czk"),
            F.bool_or("needs_custom_price").alias("needs_custom_price"),
        )
    )
    return revenue.withColumn(
        "cumulative_revenue_czk", running_sum("monthly_revenue_czk", "month")
    )


def tier_distribution(
    t: RecordTables,
    grain: str = "month",
    billable: Rule = billable_state,
    edges: Sequence[int] = TIER_EDGES,
    labels: Sequence[str] = TIER_LABELS,
) -> DataFrame:
    """Pricing tier each client reaches per month."""
    tier = band(F.col("records_created"), edges, labels)
    return _monthly(t, grain, billable).withColumn("pricing_tier", tier)


def client_pareto(t: RecordTables, billable: Rule = billable_state) -> DataFrame:
    """Clients by volume with their share and cumulative share."""
    return pareto(record_grain(t, billable=billable), client(t), "records_created")


def unbilled_records(t: RecordTables, billable: Rule = billable_state) -> DataFrame:
    """Non-deleted records outside the billable states, per client and state.

    A record without a state is unbilled and keeps a row of its own.
    """
    outside = lambda state: ~F.coalesce(billable(state), F.lit(False))
    grain = record_grain(t, {"state_id": F.col("state_id")}, outside)
    return grain.withColumnRenamed("records_created", "unbilled_records")


def duplicate_rate(
    t: RecordTables, key: str, billable: Rule | None = None
) -> DataFrame:
    """Share of a client's records that repeat an earlier ``key``.

    Keys fold to one row with their count before the client join, so a key with many copies
    weighs no more than any other.
    """
    per_key = (
        kept_records(t, billable).groupBy("client_id", key).agg(F.count(F.lit(1)).alias("n"))
    )
    stats = with_client(per_key, t).groupBy(*client(t)).agg(
        F.sum("n").alias("records"), F.countDistinct(key).alias("distinct_keys")
    )
    repeats = F.col("records") - F.col("distinct_keys")
    return stats.withColumn("duplicate_pct", pct(repeats, F.col("records"), 2))


def error_rate(t: RecordTables, error_states: Sequence[int]) -> DataFrame:
    """Share of a client's non-deleted records in one of the given error states."""
    counted = (
        kept_records(t, None)
        .groupBy("client_id")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(F.col("state_id").isin(*error_states)).alias("errors"),
        )
    )
    stats = with_client(counted, t).groupBy(*client(t)).agg(
        F.sum("records").alias("records"), F.sum("errors").alias("errors")
    )
    return stats.withColumn("error_pct", pct(F.col("errors"), F.col("records"), 2))
