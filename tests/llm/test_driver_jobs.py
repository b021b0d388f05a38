"""What the driver schedules must not grow with the shuffle's partitions or the length of chains."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from triage.llm import common


@pytest.fixture
def counted(spark):
    """(jobs of f(), its result) with 24 shuffle partitions that stay as they are."""
    conf = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}

    def run(f):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "counted")
        try:
            out = f()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), out

    for k, v in conf.items():
        spark.conf.set(k, v)
    yield run
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def smallest(edges):
    """Smallest node that each node's links reach, by brute force."""
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = sorted((root(a), root(b)))
        up[q] = p
    return {x: root(x) for x in up}


def test_bloom_filter_takes_few_jobs(spark, counted):
    keys = spark.range(5000).select((F.col("id") * 7919).alias("k"))
    jobs, bloom = counted(lambda: common.bloom_fit(keys, "k"))
    assert common.bloom_has(bloom, np.arange(5000) * 7919).all()
    assert common.bloom_has(bloom, np.arange(5000) * 7919 + 1).mean() < 0.1
    assert jobs <= 12  # one a shuffle partition before


def test_components_of_blocks_take_few_jobs(spark, counted):
    dice = random.Random(3)
    nodes = dice.sample(range(10**9), 600)
    tree = [(nodes[i], nodes[dice.randrange(max(0, i - 40), i)]) for i in range(1, 600) if i % 50]
    df = spark.createDataFrame(tree, "a long, b long")
    jobs, got = counted(lambda: common.components(df, "a", "b"))
    assert {r.node: r.root for r in got.collect()} == smallest(tree)
    assert jobs <= 110  # 170 before


@pytest.mark.parametrize("order", ["up", "down", "mixed"])
def test_components_of_long_chains_loops_and_repeats(spark, order):
    n = 120
    ids = list(range(n)) if order != "mixed" else random.Random(5).sample(range(n), n)
    chain = [*zip(ids, ids[1:], strict=False)]
    chain = [(b, a) for a, b in chain] if order == "down" else chain
    edges = [*chain, *chain[:9], (1000, 1000), (2000, 2001), (2001, 2000), *((3000, 3000 + k) for k in range(1, 60)), *((4099 - k, 4099) for k in range(1, 60))]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == smallest(edges)


def test_components_of_no_links(spark):
    assert common.components(spark.createDataFrame([], "a binary, b binary"), "a", "b").count() == 0
