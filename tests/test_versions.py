"""As-of join and heavy hitters against brute force; the queries' plans."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from triage.operators.asof import as_of_join, validity
from triage.operators.frequent import candidates, most_frequent

ZERO = datetime(2024, 1, 1)


def _days(rng):
    return ZERO + timedelta(days=rng.choice([0, 1, 29, 30, 31, 59, 60, 61, 300, -9_000, 2_900_000]), seconds=rng.choice([0, 86399, 4711]))


@pytest.mark.parametrize("days", [1, 30])
def test_as_of_join_against_all_writes(spark, days):
    rng = random.Random(days)
    log = [(rng.choice("abcd"), _days(rng), rng.choice(["x", "y", None])) for _ in range(60)]
    facts = [(i, rng.choice(["a", "a", "a", "b", "c", "e", None]), rng.choice([_days(rng), None])) for i in range(400)]
    writes = {}
    for k, t, p in log:  # of equal key and time the largest payload, null the least
        writes[k, t] = max(writes.get((k, t), ""), p or "")
    want = {}
    for i, k, t in facts:
        held = [(s, p) for (q, s), p in writes.items() if q == k and t is not None and s <= t]
        want[i] = (max(held)[0], max(held)[1] or None) if held else (None, None)
    held = validity(spark.createDataFrame(log, "k string, since timestamp_ntz, p string"), "k", "since", ["p"])
    got = as_of_join(spark.createDataFrame(facts, "i int, k string, at timestamp_ntz"), held, "k", "at", "since", days).collect()
    assert len(got) == len(facts) and {r.i: (r.since, r.p) for r in got} == want


def test_as_of_join_keeps_repeats_and_empty_sides(spark):
    facts = spark.createDataFrame([(1, "a", ZERO), (1, "a", ZERO)], "i int, k string, at timestamp_ntz")
    log = spark.createDataFrame([("a", ZERO, "x"), ("a", ZERO, "x"), (None, ZERO, "y")], "k string, since timestamp_ntz, p string")
    held = validity(log, "k", "since", ["p"])
    assert [(r.p, r.until) for r in as_of_join(facts, held, "k", "at", "since").collect()] == [("x", None)] * 2
    assert [r.p for r in as_of_join(facts, held.limit(0), "k", "at", "since").collect()] == [None, None]
    assert as_of_join(facts.limit(0), held, "k", "at", "since").collect() == []


def _want(values, n):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:n]


@pytest.mark.parametrize(("rare", "proven"), [(60_000, True), (400, True)])
def test_most_frequent_with_more_values_than_slots(spark, rare, proven):
    rng = random.Random(rare)
    values = [f"hot{i}" for i in range(12) for _ in range(4_000 + 10 * (i // 2))] + [f"r{rng.randint(0, rare)}" for _ in range(60_000)] + [None] * 9
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "w string").repartition(7)
    few = candidates(df, "w", 10, tracked=300)
    assert (few is not None) == proven and few.count() < 300
    assert [tuple(r) for r in most_frequent(df, "w", 10, "n", tracked=300).collect()] == _want(values, 10)


def test_most_frequent_of_flat_few_and_no_values(spark):
    flat = [f"v{i}" for i in range(3_000) for _ in range(1 + i % 3)]
    df = spark.createDataFrame([(v,) for v in flat], "w string")
    assert candidates(df, "w", 10, tracked=100) is None  # nothing stands out: all are counted
    assert [tuple(r) for r in most_frequent(df, "w", 10, "n", tracked=100).collect()] == _want(flat, 10)
    assert [tuple(r) for r in most_frequent(df.limit(2), "w", 10, "n").collect()] == [("v0", 1), ("v1", 1)]
    assert most_frequent(df.limit(0), "w", 10, "n").collect() == []


def test_version_queries_hold_something(spark, registry):
    from tests.conftest import SF01
    got = registry["decisions_as_of"].run(spark, SF01).agg(
        F.count(F.lit(1)).alias("n"), F.count("version_since").alias("versions"), F.count_if("agrees").alias("agree"),
        F.count("rule_category").alias("ruled")).first()
    assert got.n > got.versions > got.ruled > got.agree > 0
    assert registry["rule_version_changes"].run(spark, SF01).count() > 10


def test_version_plan_has_no_window_over_facts(spark, registry):
    from tests.conftest import SF001
    df = registry["decisions_as_of"].run(spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "Join Cross" not in plan
    assert not [x for x in plan.splitlines() if "Window" in x and "message_id" in x]
