from abacist.functions.columns import (
    amount,
    band,
    day_of,
    display_name,
    exchange,
    growth,
    month_of,
    numeric,
    pct,
    quoted,
    ratio,
    seconds_between,
    tiered_price,
    token_cost,
    whole_days,
)
from abacist.functions.distinct import distinct_sketch, estimate, standard_error, united
from abacist.functions.intervals import interval_join
from abacist.functions.joins import join_on_group
from abacist.functions.quantiles import grouped_quantiles, merged_sketch, sketch, sketch_quantile

__all__ = [
    "amount",
    "band",
    "day_of",
    "display_name",
    "distinct_sketch",
    "estimate",
    "exchange",
    "growth",
    "grouped_quantiles",
    "interval_join",
    "join_on_group",
    "merged_sketch",
    "month_of",
    "numeric",
    "pct",
    "quoted",
    "ratio",
    "seconds_between",
    "sketch",
    "sketch_quantile",
    "standard_error",
    "tiered_price",
    "token_cost",
    "united",
    "whole_days",
]
