"""Exact rounded ratios and averages.

The reference rounds ``numeric`` values half away from zero. Spark rounds decimals the same
way, so ratios are computed in decimal before ``round``; a double would round 0.15 down.
``sql_*`` give the oracle twin as exact integer arithmetic, since DuckDB divides decimals in
double precision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, digits: int = 1, scale: int = 100, as_int: bool = False) -> Column:
    """round(scale * num / den, digits), null when den is 0 or null."""
    q = F.round(F.lit(scale).cast("decimal(20,0)") * num.cast("decimal(20,0)") /
                F.nullif(den, F.lit(0)).cast("decimal(20,0)"), digits)
    return q.cast("int") if as_int else q.cast("double")


def avg_round(col: Column, digits: int = 1) -> Column:
    """round(avg(col), digits) computed exactly as sum / count."""
    return ratio(F.sum(col), F.count(col), digits, scale=1)


def sql_ratio(num: str, den: str, digits: int = 1, scale: int = 100, as_int: bool = False) -> str:
    m = 2 * scale * 10 ** digits
    core = f"((cast({m} as hugeint) * ({num}) + ({den})) // (2 * nullif({den}, 0)))"
    if as_int:
        return f"cast({core} as int)"
    return f"(cast({core} as double) / {10 ** digits})"


def sql_avg_round(col: str, digits: int = 1) -> str:
    return sql_ratio(f"sum({col})", f"count({col})", digits, scale=1)
