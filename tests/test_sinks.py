import os

import pytest
from pyspark.sql import functions as F

from abacist.sources import bundle_entries, read_bundle, report_bundle


def reports(spark, n):
    odd = spark.range(n).select(
        F.col("id"), F.lit(None).cast("string").alias("a.b"), F.array("id").alias("list"), F.lit("x,\"y\"\n").alias("text")
    )
    return {"first": spark.range(n), "odd/names": odd, "empty": spark.range(0)}


def test_bundle_is_read_through_the_manifest(spark, tmp_path):
    root = str(tmp_path)
    assert read_bundle(spark, root) == {}
    paths = report_bundle(reports(spark, 5), root)
    assert set(paths) == {"first", "odd/names", "empty"} and all(os.path.isdir(p) for p in paths.values())
    report_bundle(reports(spark, 7), root)
    for version, n in ((None, 7), (1, 5), (2, 7)):
        found = read_bundle(spark, root, version, verify=True)
        assert {k: df.count() for k, df in found.items()} == {"first": n, "odd/names": n, "empty": 0}
        assert found["odd/names"].columns == ["id", "a.b", "list", "text"]
    with pytest.raises(ValueError):
        read_bundle(spark, root, 3)
    assert {r.report: r.rows for r in bundle_entries(spark, root).collect()} == {"first": 7, "odd/names": 7, "empty": 0}


def test_a_failure_in_the_third_report_leaves_the_old_bundle(spark, tmp_path):
    root = str(tmp_path)
    report_bundle(reports(spark, 5), root)
    broken = reports(spark, 9)
    broken["empty"] = spark.range(3).select(F.raise_error(F.lit("no such rate")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no such rate"):
        report_bundle(broken, root)
    found = read_bundle(spark, root, verify=True)
    assert {k: df.count() for k, df in found.items()} == {"first": 5, "odd/names": 5, "empty": 0}
    report_bundle(reports(spark, 6), root)  # what was left behind is not in the way
    assert read_bundle(spark, root, verify=True)["first"].count() == 6


def test_a_changed_file_is_noticed(spark, tmp_path):
    root = str(tmp_path)
    paths = report_bundle({"r": spark.range(4)}, root)
    spark.range(4, 5).write.mode("append").parquet(paths["r"])
    with pytest.raises(ValueError, match="5 rows, not the 4"):
        read_bundle(spark, root, verify=True)


def test_no_reports(spark, tmp_path):
    with pytest.raises(ValueError):
        report_bundle({}, str(tmp_path))
