"""Model usage: tokens, cost and latency by client, model and time.

Costs are priced once on summed token counts, in decimals. Reports that name clients fold the
calls to one row per record first; the join with records then moves a row per record, not per
call, and distinct records become a plain count.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.bindings import TokenTables
from abacist.functions import (
    day_of,
    distinct_sketch,
    estimate,
    grouped_quantiles,
    join_on_group,
    merged_sketch,
    month_of,
    numeric,
    ratio,
    sketch,
    sketch_quantile,
    token_cost,
    united,
)
from abacist.functions.columns import INPUT_TOKEN_PRICE, OUTPUT_TOKEN_PRICE
from abacist.functions.distinct import LG_K
from abacist.operators.matrix import running_sum
from abacist.operators.records import client, with_client

PRICES = (INPUT_TOKEN_PRICE, OUTPUT_TOKEN_PRICE)
Prices = tuple[Decimal, Decimal]
_TOKENS = ["prompt_tokens", "completion_tokens", "total_tokens"]


def _cost(prompt: Column, completion: Column, prices: Prices, digits: int) -> Column:
    return F.round(token_cost(prompt, completion, *prices), digits).cast(f"decimal(18,{digits})")


def _sums(names: list[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _unit(name: str | None, at: Column) -> dict[str, Column]:
    return {None: {}, "month": {"month": month_of(at)}, "day": {"day": day_of(at)}}[name]


def token_grain(t: TokenTables, lg_k: int = LG_K) -> DataFrame:
    """The base to store once for several reports: calls and tokens per client id, model and day.

    ``known`` tells whether the record and its client exist. ``seen`` is a sketch of the distinct records: days, models
    and clients are united to any coarser unit, which a stored count could not be.
    """
    # a record has one client, so the fold per record is shuffled once and needs no distinct
    per_record = t.usage.groupBy("record_id", day_of(F.col("invoked_at")).alias("day"), "model_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("usage_id").alias("calls"),
        *_sums(_TOKENS),
        F.sum("elapsed_time_seconds").alias("seconds"),
        F.count("elapsed_time_seconds").alias("timed"),
    )
    owner = t.record.select("record_id", "client_id").join(t.client.select("client_id"), "client_id")
    owned = per_record.join(owner.withColumn("known", F.lit(True)), "record_id", "left")
    measures = ["rows", "calls", *_TOKENS, "seconds", "timed"]
    known = F.coalesce("known", F.lit(False)).alias("known")
    return owned.groupBy("client_id", known, "day", "model_name").agg(
        *_sums(measures), distinct_sketch("record_id", lg_k).alias("seen")
    )


def _by_client(t: TokenTables, calls: str, unit: str | None = None) -> DataFrame:
    """Distinct records, calls (``rows``, or ``calls`` with an id) and token sums per client name and unit of time."""
    counted = {"rows": F.count(F.lit(1)), "calls": F.count("usage_id")}[calls]
    if t.grain is not None or t.distinct_lg_k:
        if t.grain is not None:
            by = _unit(unit, F.col("day"))
            rows, seen = t.grain.where("known"), united("seen")
            counted = F.sum(calls)
        else:
            by = _unit(unit, F.col("invoked_at"))
            known = t.record.select("record_id", "client_id")
            rows, seen = t.usage.join(known, "record_id"), distinct_sketch("record_id", t.distinct_lg_k)
        per_client = rows.groupBy("client_id", *[c.alias(n) for n, c in by.items()]).agg(
            counted.alias("llm_calls"), *_sums(_TOKENS), seen.alias("_seen")
        )
        named = with_client(per_client, t).groupBy(*client(t), *by)
        return named.agg(estimate(united("_seen")).alias("records"), *_sums(["llm_calls", *_TOKENS]))
    by = _unit(unit, F.col("invoked_at"))
    per_record = t.usage.groupBy("record_id", *[c.alias(n) for n, c in by.items()]).agg(
        counted.alias("llm_calls"), *_sums(_TOKENS)
    )
    owned = per_record.join(t.record.select("record_id", "client_id"), "record_id")
    measures = ["records", "llm_calls", *_TOKENS]
    per_client = (
        owned.withColumn("records", F.lit(1).cast("bigint"))
        .groupBy("client_id", *by)
        .agg(*_sums(measures))
    )
    return with_client(per_client, t).groupBy(*client(t), *by).agg(*_sums(measures))


def _owners(t: TokenTables) -> DataFrame:
    """Records with the name of their client."""
    return with_client(t.record.select("record_id", "client_id"), t)


def _owned_calls(t: TokenTables, *columns: str) -> DataFrame:
    """Row-level calls with their client name."""
    return t.usage.select("record_id", *columns).join(_owners(t), "record_id")


def llm_cost_by_client_month(t: TokenTables, prices: Prices = PRICES) -> DataFrame:
    """Records, calls, tokens and cost per client and month."""
    monthly = _by_client(t, "rows", "month")
    return monthly.select(
        *client(t),
        "month",
        F.col("records").alias("records_processed"),
        "llm_calls",
        F.col("prompt_tokens").alias("total_prompt_tokens"),
        F.col("completion_tokens").alias("total_completion_tokens"),
        "total_tokens",
        _cost(F.col("prompt_tokens"), F.col("completion_tokens"), prices, 4).alias(
            "total_cost_eur"
        ),
    )


def llm_latency_by_client(t: TokenTables, exact: bool = True) -> DataFrame:
    """Mean, extremes and 95th percentile of the call time per client.

    Calls fold to one row per record, with a sketch of their times; the sketches are merged per client. The
    percentile is exact by one further pass over the calls, or the sketch's own without ``exact``.
    """
    elapsed, p95 = "elapsed_time_seconds", "_p95"
    per_record = t.usage.groupBy("record_id").agg(F.sum(elapsed).alias("_sum"), *sketch(elapsed))
    s = F.col("_sketch")
    stats = (
        per_record.join(_owners(t), "record_id")
        .groupBy(*client(t))
        .agg(
            F.count(F.lit(1)).alias("records_processed"),
            (F.sum("_sum") / F.nullif(F.sum(s["n"]), F.lit(0))).alias("_avg"),
            *merged_sketch(),
        )
    )
    if exact:
        calls = _owned_calls(t, elapsed)
        percentile = grouped_quantiles(
            calls, client(t), elapsed, {p95: "0.95"}, sketches=stats, spread=["record_id"]
        )
        stats = join_on_group(stats, percentile, client(t), "left")
    else:
        stats = stats.withColumn(p95, sketch_quantile("0.95"))
    figures = {"avg": F.col("_avg"), "min": s["min"], "max": s["max"], "p95": F.col(p95)}
    return stats.select(
        *client(t),
        "records_processed",
        *[numeric(x, 2).alias(f"{stat}_elapsed_sec") for stat, x in figures.items()],
    )


def token_efficiency(t: TokenTables, prices: Prices = PRICES) -> DataFrame:
    """Completion tokens as a percentage of prompt tokens per client, and the cost."""
    totals = _by_client(t, "rows")
    prompt, completion = F.col("prompt_tokens"), F.col("completion_tokens")
    return totals.select(
        *client(t),
        prompt.alias("total_prompt_tokens"),
        completion.alias("total_completion_tokens"),
        ratio(completion * 100, prompt, 2).alias("completion_pct"),
        _cost(prompt, completion, prices, 4).alias("total_cost_eur"),
    )


def calls_per_record(t: TokenTables) -> DataFrame:
    """Calls per distinct record and client; above 1 means retries or several turns."""
    totals = _by_client(t, "calls")
    return totals.select(
        *client(t),
        "records",
        "llm_calls",
        ratio(F.col("llm_calls"), F.col("records"), 2).alias("calls_per_record"),
    )


def _usage_totals(t: TokenTables, unit: str, *keys: str, records: bool = False) -> DataFrame:
    """Calls, token sums, mean time and, if asked for, distinct records of all calls per unit of time."""
    if t.grain is not None:
        by, rows = _unit(unit, F.col("day")), t.grain
        calls, mean = F.sum("calls"), F.sum("seconds") / F.nullif(F.sum("timed"), F.lit(0))
        distinct = estimate(united("seen"))
    else:
        by, rows = _unit(unit, F.col("invoked_at")), t.usage
        calls, mean = F.count("usage_id"), F.avg("elapsed_time_seconds")
        lg_k = t.distinct_lg_k
        distinct = estimate(distinct_sketch("record_id", lg_k)) if lg_k else F.countDistinct("record_id")
    return rows.groupBy(*[c.alias(n) for n, c in by.items()], *keys).agg(
        calls.alias("llm_calls"),
        *_sums(_TOKENS),
        mean.alias("_avg"),
        *([distinct.alias("records_processed")] if records else []),
    )


def model_usage_monthly(t: TokenTables, prices: Prices = PRICES) -> DataFrame:
    """Calls, tokens, mean time and cost per month and model."""
    totals = _usage_totals(t, "month", "model_name")
    return totals.select(
        "month",
        "model_name",
        "llm_calls",
        "total_tokens",
        numeric(F.col("_avg"), 2).alias("avg_elapsed_sec"),
        _cost(F.col("prompt_tokens"), F.col("completion_tokens"), prices, 4).alias(
            "total_cost_eur"
        ),
    )


def llm_daily_volume(t: TokenTables, prices: Prices = PRICES) -> DataFrame:
    """Calls, distinct records, tokens and cost per day."""
    totals = _usage_totals(t, "day", records=True)
    return totals.select(
        "day",
        "llm_calls",
        "records_processed",
        "total_tokens",
        _cost(F.col("prompt_tokens"), F.col("completion_tokens"), prices, 4).alias("cost_eur"),
    )


def slowest_calls(t: TokenTables, k: int = 50, prices: Prices = PRICES) -> DataFrame:
    """The ``k`` slowest calls with their cost; calls without a time come last, ties by id.

    Only id, record and time of all calls are moved; the rest is fetched for the ``k`` calls, by
    ``usage_id``, which is unique.
    """
    known = t.record.select("record_id", "client_id").join(t.client.select("client_id"), "client_id")
    calls = t.usage.select("usage_id", "record_id", "elapsed_time_seconds")
    slowest = [F.col("elapsed_time_seconds").desc_nulls_last(), F.col("usage_id")]
    slow = calls.join(known, "record_id").orderBy(*slowest).limit(k)
    rest = t.usage.select("usage_id", "record_id", *_TOKENS, "model_name", "invoked_at")
    top = with_client(rest.join(F.broadcast(slow), ["usage_id", "record_id"]), t)  # k rows
    return top.orderBy(*slowest).select(
        *client(t),
        "record_id",
        "elapsed_time_seconds",
        "total_tokens",
        "model_name",
        day_of(F.col("invoked_at")).alias("date"),
        _cost(F.col("prompt_tokens"), F.col("completion_tokens"), prices, 6).alias("cost_eur"),
    )


def llm_cost_trend(t: TokenTables, prices: Prices = PRICES) -> DataFrame:
    """Tokens, calls and cost per month with the running cost."""
    monthly = _usage_totals(t, "month").withColumn(
        "cost_eur", _cost(F.col("prompt_tokens"), F.col("completion_tokens"), prices, 4)
    )
    return monthly.select(
        "month",
        *_TOKENS,
        "llm_calls",
        "cost_eur",
        running_sum("cost_eur", "month").cast("decimal(18,4)").alias("cumulative_cost_eur"),
    )
