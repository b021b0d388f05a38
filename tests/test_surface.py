"""The SQL objects of rule snapshots, through spark.sql alone."""

import pytest

from triage.plans import surface

SCHEMA = "version string, is_active boolean, created_at timestamp_ntz, expires_at timestamp_ntz, invalidated_at timestamp_ntz, rules_count int"
ROWS = [("a", "true", "2024-01-01", "2024-01-02", None), ("b", "true", "2024-01-02", "2099-01-01", None),
        ("c", "true", "2024-01-02", "2099-01-01", None), ("d", "false", "2024-01-03", "2099-01-01", None),
        ("e", "false", "2024-01-01", "2099-01-01", "2024-01-02"), ("f", None, "2024-01-05", "2099-01-01", None)]


def snapshots(spark, rows=ROWS):
    raw = spark.createDataFrame([(*r, 3) for r in rows], "version string, is_active string, created_at string, expires_at string, invalidated_at string, rules_count int")
    return raw.selectExpr(*[f"cast({x} as {t}) as {x}" for x, t in (p.split() for p in SCHEMA.split(", "))])


@pytest.fixture
def log(spark):
    return surface.install(spark, snapshots(spark))


def versions(df):
    return sorted(r["version"] for r in df.collect())


def test_table_function_gives_the_newest_valid_snapshot(spark, log):
    # of equal times the greater version; an inactive or unknown one never
    assert versions(spark.sql("select * from get_active_rules_snapshot()")) == ["c"]
    assert versions(spark.sql("select version from get_active_rules_snapshot(timestamp_ntz'2100-01-01')")) == []
    joined = spark.sql("select s.version, f.rules_count from rules_snapshots s join get_active_rules_snapshot() f using (version)")
    assert versions(joined) == ["c"]


def test_view_names_each_state(spark, log):
    got = {r.version: r.status for r in spark.sql("select * from rules_cache_status").collect()}
    assert got == {"a": "expired", "b": "active", "c": "active", "d": "inactive", "e": "invalidated", "f": "inactive"}


def test_script_invalidates_once_and_the_objects_follow(spark, log):
    call = lambda reason: surface.invalidate_rules_snapshots(spark, log, reason)
    assert call("it's; a \"reason\"") == 3
    assert call("again") == 0
    assert versions(spark.sql("select * from get_active_rules_snapshot()")) == []
    got = {r.version: (r.is_active, r.invalidation_reason) for r in spark.table("rules_snapshots").collect()}
    assert got["a"] == got["b"] == got["c"] == (False, "it's; a \"reason\"")
    assert got["d"] == (False, None) and got["e"] == (False, None) and got["f"] == (None, None)


def test_no_snapshots(spark):
    log = surface.install(spark, snapshots(spark).limit(0))
    assert spark.sql("select * from get_active_rules_snapshot()").count() == 0
    assert spark.sql("select * from rules_cache_status").count() == 0
    assert surface.invalidate_rules_snapshots(spark, log, "none") == 0
