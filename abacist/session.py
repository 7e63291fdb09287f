"""Session settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings with a reason; everything else stays at Spark's default.
SETTINGS = {
    # month, day and age are calendar notions: never leave the zone to the machine
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: small sides become broadcast joins, skewed join partitions are split
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a filtered case table prunes the far larger item table before its shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Spark estimates the filtered side without its filter, so its default of 10 MB would switch this
    # off for every real case table; the filter itself stays at 64 MB or less
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "20000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "50000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 29),
    # recording a call site per expression costs more than the rest of building a report's plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str = "abacist",
    master: str | None = None,
    initial_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Session with the library's settings; ``extra`` keys use ``__`` for the dots.

    ``initial_partitions`` is the number of shuffle partitions before the adaptive planner merges
    small ones; it never splits an aggregation's. Take the bytes of the largest shuffle over 200 MB
    (50,000 for 10 TB of folded items), Spark's default of 200 is right up to 40 GB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    wide = {}
    if initial_partitions:
        wide["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    for key, value in {**SETTINGS, **wide, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
