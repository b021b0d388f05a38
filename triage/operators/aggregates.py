"""Aggregation operators that stay bounded under skew.

Rules of thumb used here:
* distinct values are de-duplicated with a shuffle (partial aggregation map-side) *before*
  they are collected, so a hot key ships each distinct value once, not every row;
* a "first N" sample uses ``row_number() <= N``, which Spark plans as WindowGroupLimit on
  both sides of the shuffle, so a hot key never sorts more than N rows per task;
* "share of grand total" reads the one-row total as a scalar subquery instead of a window
  over ``()``, which would pull every row into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_joined(df: DataFrame, keys: Sequence[str], value: Column | str, sep: str,
                    alias: str, where: Column | None = None) -> DataFrame:
    """keys -> sorted distinct non-null values joined with ``sep`` (STRING_AGG(DISTINCT ...))."""
    v = F.col(value) if isinstance(value, str) else value
    src = df if where is None else df.filter(where)
    dist = src.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull()).distinct()
    return dist.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("_v")), sep).alias(alias))


def distinct_rows(df: DataFrame, keys: Sequence[str], value: Column | str, alias: str,
                  stats: DataFrame | None = None) -> DataFrame:
    """The distinct non-null values of each group as rows (a set-valued column, unnested).

    A set grows with its group; as rows it is spread over tasks instead of built in one. With
    ``stats`` (one row per group) every group is kept, also one without values (null value).
    """
    v = F.col(value) if isinstance(value, str) else value
    dist = df.select(*keys, v.alias(alias)).filter(F.col(alias).isNotNull()).distinct()
    if stats is None:
        return dist
    from triage.operators.joins import join_null_safe
    return join_null_safe(stats, dist, keys, "left")


def first_n_distinct(df: DataFrame, keys: Sequence[str], value: Column | str, n: int) -> DataFrame:
    """keys, _v, _rn: the n smallest distinct non-null values per key."""
    v = F.col(value) if isinstance(value, str) else value
    dist = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull()).distinct()
    w = Window.partitionBy(*keys).orderBy("_v")
    return dist.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)


def sample_joined(df: DataFrame, keys: Sequence[str], value: Column | str, n: int, sep: str,
                  alias: str) -> DataFrame:
    """Sorted first n distinct values joined: bounded per key whatever the key's size."""
    top = first_n_distinct(df, keys, value, n)
    return top.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "_v"))), lambda s: s["_v"]), sep)
        .alias(alias))


def prefix_of_joined(df: DataFrame, keys: Sequence[str], value: Column | str, sep: str, width: int,
                     alias: str) -> DataFrame:
    """LEFT(STRING_AGG(DISTINCT v, sep ORDER BY v), width), exactly, from a bounded sample.

    Every value after the first adds at least ``len(sep)`` characters, so the first
    ``width`` characters come from at most ``1 + ceil(width / len(sep))`` values.
    """
    need = 1 + -(-width // max(len(sep), 1))
    j = sample_joined(df, keys, value, need, sep, "_joined")
    return j.select(*keys, F.substring("_joined", 1, width).alias(alias))


def with_share_of_total(agg: DataFrame, count_col: str, alias: str, digits: int = 2) -> DataFrame:
    """count / sum(count) over all rows, via a broadcast one-row total."""
    from triage.functions.numeric import ratio
    from triage.session import checkpoint_dir
    # the aggregate (one row per group) is read twice, for its rows and for the total: a
    # reliable checkpoint computes its lineage once; the one-row total is a scalar subquery
    checkpoint_dir(agg.sparkSession)
    agg = agg.checkpoint(eager=True)
    total = agg.agg(F.sum(count_col)).scalar()
    return agg.withColumn(alias, ratio(F.col(count_col), total, digits))


def row_numbers(df: DataFrame, groups: dict[str, Column], order: Sequence[Column | str], alias: str = "pos") -> DataFrame:
    """ROW_NUMBER over the whole table, without one task that holds it.

    ``groups`` are leading expressions of the order (not null, ascending, coarse to fine). Rows are
    numbered inside their group, and each group starts after the rows of all groups before it:
    only one count per group is ordered in one place.
    """
    d = df.withColumns(groups)
    names = list(groups)
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    start = d.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).select(
        *names, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    return d.join(start, names).withColumn(alias, (F.col("_start") + inside).cast("int")).drop("_start", *names)
