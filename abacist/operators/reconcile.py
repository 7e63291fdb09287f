"""An invoice that is released only if every item scanned is accounted for.

The counts are observed while the summary is computed, so no table is read again: at the item scan,
behind the join with cases, and on the finished summary. Each count must be the sum of what becomes of it; rows
that a join loses or repeats show as a difference, and the invoice stays unpublished. A task that is run again after
a lost executor may be counted twice: that, too, only keeps an invoice back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from abacist.bindings import Period, Pricing, UsageTables
from abacist.operators.usage import _by_user, _GRAIN_MEASURES, _priced, invoice_lines
from abacist.sources import new_dir, report_bundle


class NotReconciled(ValueError):
    """Counts that do not add up."""


@dataclass(frozen=True)
class Reconciliation:
    """What was observed; known once the summary has been computed."""

    scan: Observation
    cases: Observation
    invoice: Observation

    def counts(self) -> dict[str, int]:
        return {k: v or 0 for part in (self.scan, self.cases, self.invoice) for k, v in part.get.items()}

    def check(self) -> dict[str, int]:
        """The counts, or an error that names the first sum that does not hold."""
        n = self.counts()
        sums = {
            "scanned": ("without_id", "item_deleted", "unbillable", "billable"),
            "billable": ("without_case", "outside_period", "excluded", "case_deleted", "billed"),
            "billed": ("invoiced",),
            "billed_cases": ("invoiced_cases",),
        }
        for whole, parts in sums.items():
            if n[whole] != sum(n[p] for p in parts):
                raise NotReconciled(f"{n[whole]} {whole}, but " + ", ".join(f"{n[p]} {p}" for p in parts))
        return n


def _fates(fates: dict[str, Column], rest: str) -> Column:
    """Name of the first condition that holds, else ``rest``."""
    found = F.lit(rest)
    for name, condition in reversed(fates.items()):
        found = F.when(condition, F.lit(name)).otherwise(found)
    return found


def reconciled_summary(
    t: UsageTables, pricing: Pricing = Pricing(), period: Period | None = None
) -> tuple[DataFrame, Reconciliation]:
    """``usage_summary`` and the counts that are observed when it is computed.

    All items are scanned, also those that a filter would have pruned: they are counted as what they are.
    """
    rules, observed = t.rules, Reconciliation(Observation(), Observation(), Observation())
    fate = _fates(
        {
            "without_id": F.col("item_id").isNull(),
            "item_deleted": F.lit(False) if rules.include_deleted else ~F.coalesce(~F.col("is_deleted"), F.lit(False)),
            "unbillable": ~F.coalesce(F.col("status_id").isin(*rules.billable), F.lit(False)),
        },
        "billable",
    )
    items = t.case_item.select("case_id", fate.alias("_fate")).observe(
        observed.scan,
        F.count(F.lit(1)).alias("scanned"),
        *[F.count_if(F.col("_fate") == x).alias(x) for x in ("without_id", "item_deleted", "unbillable", "billable")],
    )
    per_case = items.where(F.col("_fate") == "billable").groupBy("case_id").agg(F.count(F.lit(1)).alias("billable_items"))

    user = F.col("user_id")
    cases = t.case.withColumn("_known", F.lit(True))
    excluded = F.lit(False)
    if isinstance(rules.excluded_users, DataFrame):
        named = rules.excluded_users.select("user_id").distinct().withColumn("_excluded", F.lit(True))
        cases, excluded = cases.join(named, "user_id", "left"), F.coalesce("_excluded", F.lit(False))
    elif rules.excluded_users:
        excluded = F.coalesce(user.isin(*rules.excluded_users), F.lit(False))
    inside = F.lit(True) if period is None else F.coalesce(period.contains(F.col("created_at")), F.lit(False))
    fate = _fates(
        {
            "without_case": F.col("_known").isNull(),
            "outside_period": ~inside,
            "excluded": excluded,
            "case_deleted": F.lit(False) if rules.include_deleted else ~F.coalesce(~F.col("is_deleted"), F.lit(False)),
        },
        "billed",
    )
    joined = per_case.join(cases, "case_id", "left").select("user_id", "billable_items", fate.alias("_fate"))
    names = ("without_case", "outside_period", "excluded", "case_deleted", "billed")
    units = F.col("billable_items")
    joined = joined.observe(
        observed.cases,
        *[F.sum(F.when(F.col("_fate") == x, units)).alias(x) for x in names],
        F.count_if(F.col("_fate") == "billed").alias("billed_cases"),
    )
    billed = joined.where(F.col("_fate") == "billed").select("user_id", units, F.lit(1).cast("bigint").alias("cases"))
    summary = _priced(_by_user(t, billed, {}, _GRAIN_MEASURES, role=True), pricing)
    summary = summary.observe(
        observed.invoice, F.sum(units).alias("invoiced"), F.sum("cases").alias("invoiced_cases")
    )
    return summary, observed


def release_invoice(
    t: UsageTables, root: str, pricing: Pricing = Pricing(), period: Period | None = None
) -> dict[str, int]:
    """Publish summary, invoice and counts as a bundle below ``root``, if the counts add up; returns them."""
    spark = t.case.sparkSession
    summary, observed = reconciled_summary(t, pricing, period)
    path = new_dir(spark, "summary")
    summary.write.parquet(path)
    counts = observed.check()
    summary = spark.read.schema(summary.schema).parquet(path)
    listed = spark.createDataFrame(list(counts.items()), "count string, items long")
    report_bundle({"summary": summary, "invoice": invoice_lines(summary, pricing), "counts": listed}, root)
    return counts
