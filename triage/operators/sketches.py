"""Mergeable distinct counts (D2, I10): sketches kept by group and day, merged for any range.

The state of a day is one HyperLogLog sketch a column; adding a batch merges sketches, so no row is read twice, and
a range of days is the union of its sketches. The relative standard error of an estimate is 1.04 / sqrt(2^lg_k)
(0.8 % at 14) whether the state came from one pass or from many batches; small sets are all but exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14


def daily_state(df: DataFrame, keys: Sequence[str], day: Column, counted: dict[str, Column], lg_k: int = LG_K) -> DataFrame:
    """(keys, day, n, a sketch for each of ``counted``); null values are not counted, null days have no state."""
    rows = df.select(*keys, day.alias("day"), *[v.cast("string").alias(k) for k, v in counted.items()]).filter("day is not null")
    return rows.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("n"), *[F.hll_sketch_agg(k, lg_k).alias(k) for k in counted])


def _union(state: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return state.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.hll_union_agg(k).alias(k) for k in columns])


def merged(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after a batch's state is added to it."""
    columns = [x for x in state.columns if x not in (*keys, "day", "n")]
    return _union(state.unionByName(batch), [*keys, "day"], columns)


def rolling(state: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """(keys, day, n, an estimate for each sketch) of the ``days`` days up to each day that has a state.

    Each day's state, a few kB, goes to the ends of the ranges it lies in; mail is not read.
    """
    columns = [x for x in state.columns if x not in (*keys, "day", "n")]
    ends = state.select(*keys, "day").distinct()
    dealt = state.withColumn("day", F.explode(F.sequence("day", F.date_add("day", days - 1))))
    got = _union(dealt, [*keys, "day"], columns)
    on = [ends[k].eqNullSafe(got[k]) for k in (*keys, "day")]
    kept = got.join(ends, on, "left_semi")
    return kept.select(*keys, "day", "n", *[F.hll_sketch_estimate(k).alias(k) for k in columns])
