"""Constraint checks as a data-driven violations report.

The reference enforces enums, ranges, not-null, unique keys and foreign keys in DDL. Parquet
has none of that, so the checks run as jobs: one aggregate per table for the row rules, one
group-by per unique key, and one anti join of all tables' tagged child keys against the
parent, so the parent is scanned once (a shuffle join; the growing parent is never broadcast).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.registry import register
from triage.schemas import ENUMS, FOREIGN_KEYS, NOT_NULL, RANGES, UNIQUE

c = F.col


def _row(df: DataFrame, table: str, check: str, cols: str, n) -> DataFrame:
    return df.agg(n.cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), F.lit(cols).alias("columns"),
        "violations")


def violations(fx) -> DataFrame:
    """All checks, one aggregate per table for the row-level rules (enum, range, not null),
    one group-by per unique key and one anti join per foreign key; rows stacked by unpivot."""
    parts = []
    tables = sorted({t for (t, _) in ENUMS} | {t for (t, _) in RANGES} | set(NOT_NULL))
    for t in tables:
        df = getattr(fx, t)
        checks = []
        for (tt, col), allowed in ENUMS.items():
            if tt == t:
                checks.append((f"enum|{col}", F.count_if(c(col).isNotNull() & ~c(col).isin(list(allowed)))))
        for (tt, col), (lo, hi) in RANGES.items():
            if tt == t:
                checks.append((f"range|{col}", F.count_if((c(col) < lo) | (c(col) > hi))))
        for col in NOT_NULL.get(t, ()):
            checks.append((f"not_null|{col}", F.count_if(c(col).isNull())))
        agg = df.agg(*[e.cast("bigint").alias(name) for name, e in checks])
        long = agg.unpivot([], [name for name, _ in checks], "check", "violations")
        parts.append(long.select(F.lit(t).alias("table_name"), F.split_part("check", F.lit("|"), F.lit(1)).alias(
            "check_name"), F.split_part("check", F.lit("|"), F.lit(2)).alias("columns"), "violations"))
    # unique keys: one group-by per table on its own key columns (partial aggregation absorbs a hot key)
    for t, keys in UNIQUE.items():
        dup = getattr(fx, t).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(c("n") > 1)
        parts.append(_row(dup, t, "unique", ",".join(keys), F.coalesce(F.sum(c("n") - 1), F.lit(0))))
    # foreign keys: all child keys tagged with their table, one anti join against the parent
    children = reduce(DataFrame.unionByName, [
        getattr(fx, t).select(F.lit(t).alias("table_name"), c(key).alias("message_id")).filter(c("message_id").isNotNull())
        for t, key in FOREIGN_KEYS.items()])
    orphan = (children.join(fx.mail.select("message_id"), "message_id", "left_anti")
              .groupBy("table_name").agg(F.count(F.lit(1)).alias("n")))
    fks = fx.spark.createDataFrame(list(FOREIGN_KEYS.items()), "table_name string, columns string")
    parts.append(fks.join(orphan, "table_name", "left").select(
        "table_name", F.lit("foreign_key").alias("check_name"), "columns",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("violations")))
    return reduce(DataFrame.unionByName, parts)


def _sql_violations() -> str:
    q = []
    for (t, col), allowed in ENUMS.items():
        vals = ", ".join("'" + v + "'" for v in allowed)
        q.append(f"select '{t}', 'enum', '{col}', count(*) filter (where {col} is not null and {col} not in ({vals})) "
                 f"from {t}")
    for (t, col), (lo, hi) in RANGES.items():
        q.append(f"select '{t}', 'range', '{col}', count(*) filter (where {col} < {lo} or {col} > {hi}) from {t}")
    for t, cols in NOT_NULL.items():
        for col in cols:
            q.append(f"select '{t}', 'not_null', '{col}', count(*) filter (where {col} is null) from {t}")
    for t, keys in UNIQUE.items():
        k = ", ".join(keys)
        q.append(f"select '{t}', 'unique', '{','.join(keys)}', coalesce(sum(n - 1), 0) from "
                 f"(select {k}, count(*) as n from {t} group by {k} having count(*) > 1) d")
    for t, key in FOREIGN_KEYS.items():
        q.append(f"select '{t}', 'foreign_key', '{key}', count(*) from {t} x where x.{key} is not null and not exists "
                 f"(select 1 from mail m where m.message_id = x.{key})")
    body = "\nunion all ".join(q)
    return ("select table_name, check_name, columns, cast(violations as bigint) as violations from (\n"
            + body + "\n) as v(table_name, check_name, columns, violations)")


_USES = sorted({t for (t, _) in ENUMS} | {t for (t, _) in RANGES} | set(NOT_NULL) | set(UNIQUE) | set(FOREIGN_KEYS)
               | {"mail"})


@register("constraint_violations", ops="B12 C3 D9 G1", uses=" ".join(_USES), sql=_sql_violations())
def constraint_violations(fx) -> DataFrame:
    return violations(fx)


@register("orphans", ops="B12 C3", uses="body mail feedback desired_state", sql="""
select 'body' as table_name, message_id from body where message_id not in (select message_id from mail)
union all select 'feedback', message_id from feedback where message_id not in (select message_id from mail)
union all select 'desired_state', message_id from desired_state where message_id not in (select message_id from mail)""")
def orphans(fx) -> DataFrame:
    keys = fx.mail.select("message_id")
    out = [getattr(fx, t).select("message_id").join(keys, "message_id", "left_anti")
           .select(F.lit(t).alias("table_name"), "message_id") for t in ("body", "feedback", "desired_state")]
    return reduce(DataFrame.unionByName, out)
