"""Written tables: no exchange under the base joins, reloads and logs read back, sketches that merge."""

import pytest
from pyspark.sql import functions as F

from triage.operators import colocated, sketches, writes
from triage.plans import mining, stored, sync
from tests.conftest import rows


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, as large tables have them."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_base_joins_of_mining_and_sync_have_no_exchange(spark, fx001, shuffled):
    held = stored.Colocated(fx001, buckets=8)
    base = mining.mining_base(held)
    assert "SortMergeJoin" in plan(base) and "Exchange" not in plan(base)
    assert "Exchange" in plan(mining.mining_base(fx001))
    diff = sync.state_diff(held)
    assert "SortMergeJoin" in plan(diff) and "Exchange" not in plan(diff)
    cols = ["message_id", "primary_category", "return_path", "relevance"]
    assert rows(base.select(cols)) == rows(mining.mining_base(fx001).select(cols))


def test_tables_of_other_bucket_counts_join(spark, shuffled):
    a = colocated.write_bucketed(spark.range(1000).select(F.expr("if(id % 7 = 0, null, id)").alias("k"), "id"), "k", 8, "a")
    b = colocated.write_bucketed(spark.range(0, 1000, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "k", 16, "b")
    got = a.join(b, "k")
    assert sorted(r.k for r in got.collect()) == [k for k in range(0, 1000, 3) if k % 7]
    assert a.filter("k is null").count() == 143


def test_bucket_counts_are_powers_of_two_within_bounds():
    per = colocated.ROWS_PER_BUCKET
    assert [colocated.bucket_count(n) for n in (0, 8 * per, 8 * per + 1, 100 * per)] == [8, 8, 16, 128]
    assert colocated.bucket_count(10 ** 15) == colocated.MOST


def test_empty_and_single_key_tables(spark):
    empty = colocated.write_bucketed(spark.range(0).withColumnRenamed("id", "k"), "k", 8, "e")
    one = colocated.write_bucketed(spark.range(500).select(F.lit(1).cast("long").alias("k"), "id"), "k", 8, "o")
    assert (empty.count(), one.count(), one.join(empty, "k").count()) == (0, 500, 0)


def test_current_follows_truncations_and_appends(spark):
    t = f"t_{colocated.uuid.uuid4().hex}"
    of = lambda *xs: spark.createDataFrame([(x,) for x in xs], "x int")
    writes.apply(of(1), t, "append")
    writes.apply(of(2), t, "append")
    assert rows(writes.current(spark, t)) == [(1,), (2,)]
    writes.apply(of(3, 4), t)
    assert rows(writes.current(spark, t)) == [(3,), (4,)]
    writes.apply(of(5), t, "append")
    assert rows(writes.current(spark, t)) == [(3,), (4,), (5,)]
    writes.apply(of(6).limit(0), t)
    assert rows(writes.current(spark, t)) == []


def _facts(spark, n):
    """n rows over 20 days; a third of them one group, values repeat."""
    return spark.range(n).select(
        F.expr("if(id % 3 = 0, 'hot', concat('g', id % 5))").alias("g"),
        F.expr("date_add(date'2024-01-01', cast(pmod(xxhash64(id), 20) as int))").alias("d"),
        F.expr("if(id % 50 = 0, null, pmod(xxhash64(id, 7), 40000))").alias("v"))


def test_union_of_batches_equals_one_pass_and_holds_the_bound(spark):
    df = _facts(spark, 120_000)
    state = lambda x: sketches.daily_state(x, ["g"], F.col("d"), {"v": F.col("v")})
    whole = state(df)
    merged = state(df.limit(0))
    for i in range(3):
        merged = sketches.merged(merged, state(df.filter(F.pmod(F.xxhash64("v", "d"), F.lit(3)) == i)), ["g"])
    one = {r[:2]: r[2:] for r in rows(sketches.rolling(whole, ["g"], 7))}
    many = {r[:2]: r[2:] for r in rows(sketches.rolling(merged, ["g"], 7))}
    assert one.keys() == many.keys() and all(one[k][0] == many[k][0] for k in one)
    ends = df.select("g", "d").distinct().withColumnRenamed("d", "e")
    exact = {(r.g, r.e): (r.n, r.v) for r in df.join(ends, "g").filter("d between date_sub(e, 6) and e")
             .groupBy("g", "e").agg(F.count("*").alias("n"), F.count_distinct("v").alias("v")).collect()}
    assert {k: v[0] for k, v in one.items()} == {k: v[0] for k, v in exact.items()}
    bound = 4 * 1.04 / 2 ** (sketches.LG_K / 2)
    for got in (one, many):
        assert all(abs(got[k][1] - exact[k][1]) <= bound * exact[k][1] + 1 for k in exact)
    assert max(v for _, v in exact.values()) > 10_000


def test_sketches_of_null_groups_null_values_and_no_rows(spark):
    df = spark.createDataFrame([(None, "2024-01-01", "a"), (None, "2024-01-01", None), ("x", "2024-01-03", None), ("x", None, "b")],
                               "g string, d string, v string").withColumn("d", F.to_date("d"))
    state = sketches.daily_state(df, ["g"], F.col("d"), {"v": F.col("v")})
    got = {(r.g, str(r.day)): (r.n, r.v) for r in sketches.rolling(state, ["g"], 3).collect()}
    assert got == {(None, "2024-01-01"): (2, 1), ("x", "2024-01-03"): (1, 0)}
    assert sketches.rolling(state.limit(0), ["g"], 3).count() == 0


def test_reach_equals_exact_counts_of_small_sets(fx001):
    lab = stored.labelled(fx001).select("primary_category", F.to_date("decided_at").alias("d"), F.lower("from_address").alias("a"))
    ends = lab.select("primary_category", F.col("d").alias("day")).filter("day is not null").distinct()
    exact = lab.join(ends, "primary_category").filter("d between date_sub(day, 6) and day").groupBy("primary_category", "day").agg(
        F.count("*").alias("decisions"), F.count_distinct("a").alias("senders"))
    assert rows(stored.reach_7d(fx001).select("primary_category", "day", "decisions", "senders")) == rows(exact)
