"""Exact most frequent values by a bounded summary and a recount of its candidates.

One aggregation keeps a frequent-items summary of ``tracked`` values, merged map-side, in place of
a shuffle of every distinct value. With m slots (the power of two above tracked / 0.75) and N values
seen, an estimate exceeds a value's count by at most E = 3.5 N / m, never falls below it, and a value
outside the summary stands at most E times. Let t be the n-th largest estimate less E. At least n
values stand t times or more, so the n most frequent do. If t > E none of them is outside the summary, and those in it have
estimates of t or more: these are recounted exactly. If not (a flat distribution), all values are counted.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.session import checkpoint_dir

c = F.col
RECOUNT = 100_000  # candidates that are broadcast at most


def candidates(values: DataFrame, col: str, n: int, tracked: int = 10_000) -> DataFrame | None:
    """(col) rows that hold the ``n`` most frequent values for certain; None: the bound proves nothing."""
    if n > tracked:
        return None
    checkpoint_dir(values.sparkSession)
    top = values.filter(c(col).isNotNull()).agg(
        F.expr(f"approx_top_k({col}, {tracked}, {tracked})").alias("top"), F.count(F.lit(1)).alias("seen")).checkpoint()  # one row
    row = top.select("seen", F.expr(f"try_element_at(top, {n}).count").alias("nth")).first()
    slots = 1 << math.ceil(math.log2(tracked / 0.75))
    wrong = math.ceil(3.5 * row.seen / slots)
    least = (row.nth or 0) - wrong
    if least <= wrong:
        return None
    return top.select(F.explode("top").alias("t")).filter(c("t.count") >= least).select(c("t.item").alias(col))


def most_frequent(values: DataFrame, col: str, n: int, alias: str, tracked: int = 10_000) -> DataFrame:
    """(col, alias): the ``n`` most frequent values with exact counts, ties to the smaller value; nulls don't count."""
    values = values.select(col).filter(c(col).isNotNull())
    few = candidates(values, col, n, tracked)
    if few is not None:
        small = few.count() <= RECOUNT
        values = values.join(F.broadcast(few) if small else few, col, "left_semi")
    return values.groupBy(col).agg(F.count(F.lit(1)).alias(alias)).orderBy(c(alias).desc(), c(col)).limit(n)
