"""Operators: writes, joins, aggregates, array multiset compare."""

from pyspark.sql import functions as F

from triage.operators.aggregates import prefix_of_joined, sample_joined
from triage.operators.joins import contains_join, first_by_priority, join_null_safe
from triage.operators.writes import apply, insert_if_absent, touch, update_from, upsert
from triage.plans.audit import sorted_or_empty
from tests.conftest import rows


def test_upsert_is_idempotent_and_keeps_untouched_columns(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    u = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    once = upsert(t, u, ["k"], ["v"])
    twice = upsert(once, u, ["k"], ["v"])
    assert rows(once) == [("a", 1, "x"), ("b", 20, "y"), ("c", 30, None)]
    assert rows(twice) == rows(once)


def test_insert_if_absent_keeps_existing(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    n = spark.createDataFrame([("a", 9), ("b", 2), ("b", 2)], "k string, v int")
    assert rows(insert_if_absent(t, n, ["k"])) == [("a", 1), ("b", 2)]


def test_update_from(spark):
    t = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, flag string")
    s = spark.createDataFrame([("b", "z")], "k string, flag string")
    out = update_from(t, s, ["k"], {"flag": F.col("src_flag")})
    assert rows(out) == [("a", "x"), ("b", "z")]


def test_contains_join_against_brute_force(spark, fx01):
    texts = fx01.mail.select("message_id", F.lower("from_address").alias("a"))
    pats = spark.createDataFrame([("ann1",), ("u7.p",), ("news1",), ("",), (None,), ("n" * 500,)], "p string")
    got = rows(contains_join(texts, "a", pats, "p").select("message_id", "p"))
    want = rows(texts.crossJoin(pats.filter("p <> ''")).filter("instr(a, p) > 0").select("message_id", "p"))
    assert got == want and got


def test_contains_join_keeps_equal_rows_and_many_patterns(spark):
    texts = spark.createDataFrame([("aXbXa",), ("aXbXa",), (None,), ("",)], "t string")
    assert rows(contains_join(texts, "t", spark.createDataFrame([("X",)], "p string"), "p")) == [("aXbXa", "X")] * 2
    pats = spark.createDataFrame([(str(i),) for i in range(3000)] + [("X",)], "p string")
    assert rows(contains_join(texts, "t", pats, "p")) == [("aXbXa", "X")] * 2


def test_first_by_priority_total_order(spark):
    df = spark.createDataFrame([("m", 20, "b", "x"), ("m", 10, "z", "y"), ("m", 10, "a", "w")],
                               "id string, pr int, t string, v string")
    assert rows(first_by_priority(df, ["id"], ["pr", "t"], ["v"])) == [("m", "w")]


def test_null_safe_join_keeps_null_group(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10)], "k string, b int")
    assert rows(join_null_safe(a, b, ["k"], "left")) == [("x", 2, None), (None, 1, 10)]


def test_sample_and_prefix_are_bounded_and_sorted(spark):
    df = spark.createDataFrame([("k", f"s{i:03d}") for i in range(500)] + [("k", None)], "k string, s string")
    got = sample_joined(df, ["k"], "s", 3, " | ", "x").collect()[0]["x"]
    assert got == "s000 | s001 | s002"
    pre = prefix_of_joined(df, ["k"], "s", " | ", 20, "p").collect()[0]["p"]
    assert pre == " | ".join(f"s{i:03d}" for i in range(500))[:20]


def test_array_multiset_compare(spark):  # T7
    df = spark.createDataFrame([([], None), (["a", "b"], ["b", "a"]), (["a", "a"], ["a"])],
                               "x array<string>, y array<string>")
    got = [r[0] for r in df.select(sorted_or_empty(F.col("x")).eqNullSafe(sorted_or_empty(F.col("y")))).collect()]
    assert got == [True, True, False]


def test_apply_writes_a_fresh_version(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    p1, p2 = apply(df, "t_apply"), apply(df, "t_apply")
    assert p1 != p2 and rows(spark.read.parquet(p1)) == [("a", 1)]


def test_touch_sets_updated_at_only_on_change(spark):
    df = spark.createDataFrame([("a", "x", "x", None), ("b", "y", "z", None)],
                               "k string, flag string, old_flag string, updated_at timestamp_ntz")
    out = touch(df, "old_", ["flag"], "2024-01-31 00:00:00").select("k", F.col("updated_at").isNotNull())
    assert rows(out) == [("a", False), ("b", True)]


def test_written_table_overwrite_append_and_read_back(spark):
    import uuid

    from triage.operators.writes import apply, current
    name = f"t{uuid.uuid4().hex}"
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    apply(df(1, 2), name)
    apply(df(3), name, mode="append")
    assert rows(current(spark, name)) == [(1,), (2,), (3,)]
    apply(df(9), name)
    assert rows(current(spark, name)) == [(9,)]
    apply(df(10), name, mode="append")
    assert rows(current(spark, name)) == [(10,), (9,)]


def test_duplicate_keys_resolve_the_same_way_each_time(spark):
    from triage.operators.writes import insert_if_absent, upsert
    target = spark.createDataFrame([("k", "old", 0)], "k string, v string, o int")
    new = spark.createDataFrame([("k", "b", 2), ("k", "a", 3), ("n", "y", 5), ("n", "x", 4)], "k string, v string, o int")
    for shuffled in (new, new.orderBy(F.desc("v"))):
        assert rows(upsert(target, shuffled, ["k"])) == [("k", "a", 3), ("n", "x", 4)]
        assert rows(upsert(target, shuffled, ["k"], order=["o"])) == [("k", "b", 2), ("n", "x", 4)]
        assert rows(insert_if_absent(target, shuffled, ["k"])) == [("k", "old", 0), ("n", "x", 4)]


def test_cluster_without_a_shared_folder_is_an_error():
    import pytest

    from triage.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"getCheckpointDir": lambda self: None})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
