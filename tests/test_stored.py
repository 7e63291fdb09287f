import os
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from abacist import UsageRules, UsageTables
from abacist.operators import stored, usage
from abacist.sources import manifest

CASE = "case_id bigint, user_id string, created_at timestamp, is_deleted boolean, modified_at timestamp"
ITEM = "item_id bigint, case_id bigint, status_id int, is_deleted boolean, modified_at timestamp"


def tables(spark, cases, items, stamped=True, rules=UsageRules(excluded_users=("x",), include_deleted=False)):
    case, item = (
        df.withColumns({c: F.col(c).cast("timestamp") for c in ("created_at", "modified_at") if c in df.columns})
        for df in (
            spark.createDataFrame(cases, CASE.replace("timestamp", "string")),
            spark.createDataFrame(items, ITEM.replace("timestamp", "string")),
        )
    )
    if not stamped:
        case, item = case.drop("modified_at"), item.drop("modified_at")
    user = spark.sql(
        "SELECT * FROM VALUES ('a', 'Ann', 'Lee', 'a@x', 1), ('b', 'Bo', 'Ray', 'b@x', 2), ('c', 'Bo', 'Ray', 'c@x', 9)"
        " AS t(user_id, first_name, last_name, email, role_id)"
    )
    role = spark.sql("SELECT * FROM VALUES (1, 'lead'), (2, 'staff') AS t(role_id, role_name)")
    return UsageTables(case=case, case_item=item, user=user, user_role=role, rules=rules)


OLD, NEW = "2026-01-31 00:00:00", "2026-02-02 10:00:00.25"
USERS = ["a", "b", "c", None, "x"]


def state(edited):
    """Cases over many months; the edited state moves, changes, deletes and adds some."""
    cases, items = [], []
    for i in range(60):
        day, user, deleted, at = i % 20 + 1, USERS[i % 5], i % 17 == 3, OLD
        month = i % 10 + 1
        if edited and i in (5, 25):  # to another month, one that has no other case, and to another day
            month, day, at = (12, day, NEW) if i == 5 else (month, day + 1, NEW)
        if edited and i == 7:
            user, at = "a", NEW
        if edited and i == 8:
            deleted, at = True, NEW
        if edited and i == 46:  # gone for good
            continue
        stamp = None if i == 49 else f"2025-{month:02d}-{day:02d} 08:00:00"
        cases.append((i, user, stamp, deleted, at))
        for j in range(i % 4):
            status, when = (5 if (i + j) % 3 else 1), OLD
            if edited and i == 11 and j == 0:
                status, when = 3, NEW
            if edited and i in (13, 33):  # no billable item is left of these
                status, when = 1, NEW
            items.append((10 * i + j, i, status, False, when))
    if edited:
        cases.append((100, "b", "2025-02-02 23:59:59", False, NEW))
        items += [(1000 + j, 100, 2, False, NEW) for j in range(3)]
    return cases, items


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_refresh_equals_a_full_build(spark, tmp_path):
    root = str(tmp_path / "store")
    before, after = tables(spark, *state(False)), tables(spark, *state(True))
    assert stored.refresh_grain(before, root) == 1  # there is none yet
    assert rows_of(stored.read_grain(before, root)) == rows_of(usage.daily_grain(before))
    gone = spark.sql("SELECT 46L AS case_id")
    assert stored.refresh_grain(after, root, gone) == 2
    assert rows_of(stored.read_grain(after, root)) == rows_of(usage.daily_grain(after))
    assert rows_of(stored.read_grain(before, root, version=1)) == rows_of(usage.daily_grain(before))
    grained = replace(after, grain=stored.read_grain(after, root))
    assert rows_of(usage.daily_volume(grained)) == rows_of(usage.daily_volume(after))
    # months without a change keep their files
    _, first, _ = stored._state(spark, root, 1)
    _, second, state_2 = stored._state(spark, root, 2)
    touched = {d for d in first.keys() | second.keys() if first.get(d) != second.get(d)}
    assert {d.month for d in touched} <= {2, 4, 6, 7, 8, 9, 12} and len(touched) > 3
    assert {second[d] for d in second if d not in touched} == {next(iter(first.values()))}
    assert state_2["watermark"] == "2026-02-02 10:00:00.25"
    # nothing is younger than the watermark: no new version, unless lateness looks back
    assert stored.refresh_grain(after, root) == 2
    assert stored.refresh_grain(after, root, lateness=timedelta(days=9)) == 3
    assert rows_of(stored.read_grain(after, root)) == rows_of(usage.daily_grain(after))


def test_names_and_roles_are_those_of_today(spark, tmp_path):
    t = tables(spark, *state(False))
    root = str(tmp_path)
    stored.build_grain(t, root)
    renamed = replace(t, user=t.user.withColumn("last_name", F.lit("New")), rules=replace(t.rules, by_user_id=True))
    assert rows_of(stored.read_grain(renamed, root)) == rows_of(usage.daily_grain(renamed))


def test_without_stamps_changes_are_named(spark, tmp_path):
    root = str(tmp_path)
    before, after = tables(spark, *state(False), stamped=False), tables(spark, *state(True), stamped=False)
    stored.build_grain(before, root)
    with pytest.raises(ValueError):
        stored.refresh_grain(after, root)
    every = before.case.select("case_id").union(after.case.select("case_id"))
    stored.refresh_grain(after, root, every)
    assert rows_of(stored.read_grain(after, root)) == rows_of(usage.daily_grain(after))


def test_other_rules_need_another_store(spark, tmp_path):
    stored.build_grain(tables(spark, *state(False)), str(tmp_path))
    with pytest.raises(ValueError, match="rules"):
        stored.refresh_grain(tables(spark, *state(True), rules=UsageRules()), str(tmp_path))


def test_a_refresh_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    before, after = tables(spark, *state(False)), tables(spark, *state(True))
    stored.build_grain(before, root)

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(manifest, "publish", fail)
        with pytest.raises(OSError):
            stored.refresh_grain(after, root)
    assert rows_of(stored.read_grain(before, root)) == rows_of(usage.daily_grain(before))
    assert stored.refresh_grain(after, root, spark.sql("SELECT 46L AS case_id")) == 2
    assert rows_of(stored.read_grain(after, root)) == rows_of(usage.daily_grain(after))


def test_empty_tables_and_an_emptied_store(spark, tmp_path):
    root = str(tmp_path)
    none = tables(spark, [], [])
    assert stored.build_grain(none, root) == 1
    assert stored.read_grain(none, root).collect() == []
    some = tables(spark, *state(False))
    assert stored.refresh_grain(some, root) == 2
    every = some.case.select("case_id")
    assert stored.refresh_grain(none, root, every) == 3
    assert stored.read_grain(none, root).collect() == []
