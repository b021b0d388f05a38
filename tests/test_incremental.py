"""Incremental mining: batches of signed rows against mining the end state at once."""

import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from triage.operators.joins import contains_join
from triage.plans import incremental
from triage.plans.incremental import MiningState, change_log
from triage.plans.mining import rule_mining


def end_state(spark, log, batches):
    state = MiningState.empty(spark)
    for b in batches:
        state = state.changed(log.filter(F.col("batch") == b), log.filter(F.col("batch").isin(batches[:batches.index(b) + 1])))
    return state


def test_every_prefix_equals_mining_at_once(spark, fx001):
    log = change_log(fx001).checkpoint()
    columns = [x for x in log.columns if x not in ("batch", "sign")]
    state = MiningState.empty(spark)
    for b in range(4):
        upto = log.filter(F.col("batch") <= b)
        state = state.changed(log.filter(F.col("batch") == b), upto)
        left = upto.groupBy(*columns).agg(F.sum("sign").alias("sign")).filter("sign > 0").checkpoint()
        once = MiningState.empty(spark).changed(left, left)
        assert rows(state.metrics()) == rows(once.metrics())
        assert rows(state.cells) == rows(once.cells) and rows(state.subjects) == rows(once.subjects)
    got = incremental.rule_mining_incremental(fx001)
    assert rows(got) == rows(rule_mining(fx001).select(got.columns))


def test_other_cut_into_batches_same_state(spark, fx001):
    log = change_log(fx001).checkpoint()
    whole = MiningState.empty(spark).changed(log, log)
    want = end_state(spark, log, [0, 1, 2, 3])
    assert rows(whole.cells) == rows(want.cells) and rows(whole.subjects) == rows(want.subjects) and whole.total.first() == want.total.first()


def test_everything_leaves(spark, fx001):
    log = change_log(fx001).filter("sign > 0 and batch = 0").checkpoint()
    both = log.unionByName(log.withColumn("sign", F.lit(-1)))
    state = MiningState.empty(spark).changed(log, log).changed(log.withColumn("sign", F.lit(-1)), both)
    assert state.cells.isEmpty() and state.subjects.isEmpty() and state.total.first().n == 0 and state.metrics().isEmpty()


def test_a_lost_extreme_is_found_again(spark, fx001):
    log = change_log(fx001).filter("batch = 0 and sign > 0").checkpoint()
    first = log.agg(F.min("decided_at")).first()[0]
    gone = log.filter(F.col("decided_at") == F.lit(first)).withColumn("sign", F.lit(-1))
    state = MiningState.empty(spark).changed(log, log).changed(gone, log.unionByName(gone))
    rest = log.filter(F.col("decided_at") != F.lit(first))
    assert rows(state.metrics()) == rows(MiningState.empty(spark).changed(rest, rest).metrics())


def test_retracting_what_is_not_there(spark, fx001):
    log = change_log(fx001).filter("batch = 0").limit(5).withColumn("sign", F.lit(-1))
    with pytest.raises(PySparkException):
        MiningState.empty(spark).changed(log, log).cells.collect()


def test_saved_state_goes_on(spark, fx001):
    log = change_log(fx001).checkpoint()
    state = end_state(spark, log, [0, 1])
    again = MiningState.load(spark, state.save())
    for b in (2, 3):
        again = again.changed(log.filter(F.col("batch") == b), log.filter(F.col("batch") <= b))
    assert rows(again.metrics()) == rows(end_state(spark, log, [0, 1, 2, 3]).metrics())


@pytest.mark.parametrize("gram", [1, 2, 4])
def test_contains_join_is_all_pairs(spark, gram):
    rng = random.Random(gram)
    texts = [(i, rng.choice([None, "", *("".join(rng.choice("abé.") for _ in range(rng.randint(0, 9))) for _ in range(8))])) for i in range(80)]
    pats = [(rng.choice([None, "", "a", "ab", "aba", "é.a", "abab.", "b"]), k) for k in range(12)]
    got = contains_join(spark.createDataFrame(texts, "i int, t string"), "t", spark.createDataFrame(pats, "p string, k int"), "p", gram)
    assert sorted(tuple(r) for r in got.select("i", "t", "p", "k").collect()) == sorted(
        (i, t, p, k) for i, t in texts for p, k in pats if t is not None and p and p in t)


def test_contains_join_explodes_the_dictionary(spark):
    """Rows that share a text are joined back after the search: the texts under the explode are distinct."""
    texts = spark.range(100_000).select("id", F.concat(F.lit("user"), F.col("id") % 7).alias("t"))
    got = contains_join(texts, "t", spark.createDataFrame([("ser3",)], "p string"), "p")
    assert got.count() == 100_000 // 7 + (100_000 % 7 > 3)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("Generate")
    assert re.search(r"Aggregate \[(_text|_groupingexpression|id|t)#", plan[at:]), plan
