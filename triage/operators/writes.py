"""Set-based write operators (A3-A8, A15, K29) without a lakehouse table format.

Each operator returns the *new table state* as a lazy DataFrame (the preview, A15); ``apply``
writes it to a fresh versioned folder under the shared checkpoint location and never reads
and overwrites the same path. Keys are matched null-safely like a primary key would be.

* ``upsert``            INSERT .. ON CONFLICT DO UPDATE (A4): one full outer join on the key;
                        updated columns from the update, the rest from the old row.
* ``insert_if_absent``  INSERT .. ON CONFLICT DO NOTHING (A3).
* ``update_from``       UPDATE .. FROM (A7): left join + coalesce projection.
* ``touch``             updated_at = as_of when any tracked column changed (K29).
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.session import checkpoint_dir

c = F.col


def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(right[k])
        cond = e if cond is None else cond & e
    return cond


def first_of_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the least by ``order`` and then by all other columns, so a rerun picks the same."""
    rest = [x for x in df.columns if x not in keys]
    if not rest:
        return df.distinct()
    least = F.min(F.struct(*[c(x) for x in order or ()], F.struct(*rest).alias("_row"))).alias("_m")
    return df.groupBy(*keys).agg(least).select(*keys, "_m._row.*").select(df.columns)


def insert_if_absent(target: DataFrame, new_rows: DataFrame, keys: Sequence[str],
                     order: Sequence[str] | None = None) -> DataFrame:
    fresh = first_of_key(new_rows, keys, order)
    add = fresh.join(target.select(*keys), _key_cond(fresh, target, keys), "left_anti")
    return target.unionByName(add.select(*target.columns))


def inserted_rows(target: DataFrame, new_rows: DataFrame, keys: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """The rows an insert-if-absent would add (what RETURNING would give)."""
    fresh = first_of_key(new_rows, keys, order)
    return fresh.join(target.select(*keys), _key_cond(fresh, target, keys), "left_anti")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """New state of ``target`` after upserting ``updates`` on ``keys``; of updates with one key the
    first by ``order`` counts.

    ``update_cols`` are taken from the update; the target's other columns survive for
    existing keys (ON CONFLICT DO UPDATE SET only those columns).
    """
    update_cols = list(update_cols or [x for x in updates.columns if x not in keys])
    # one full outer join on the (null-safe) key: each side is shuffled once
    upd = first_of_key(updates, keys, order).select(
        *[c(k).alias(f"_u_{k}") for k in keys], *[c(x).alias(f"_u_{x}") for x in updates.columns if x not in keys],
        F.lit(True).alias("_u_hit"))
    cond = None
    for k in keys:
        e = c(k).eqNullSafe(c(f"_u_{k}"))
        cond = e if cond is None else cond & e
    j = target.join(upd, cond, "full")
    hit = F.coalesce(c("_u_hit"), F.lit(False))
    cols = []
    for col in target.columns:
        if col in keys:
            cols.append(F.when(hit, c(f"_u_{col}")).otherwise(c(col)).alias(col))
        elif col in update_cols:
            new = c(f"_u_{col}") if col in updates.columns else F.lit(None)
            cols.append(F.when(hit, new).otherwise(c(col)).alias(col))
        else:
            cols.append(c(col))
    return j.select(*cols)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str],
                assignments: dict[str, Column]) -> DataFrame:
    """UPDATE target SET col = expr FROM source WHERE keys match; other rows unchanged.

    ``assignments`` expressions may use ``source`` columns (prefixed ``src_``).
    """
    src = source.select(*keys, *[c(x).alias(f"src_{x}") for x in source.columns if x not in keys]) \
        .withColumn("_hit", F.lit(True))
    j = target.join(src, list(keys), "left")
    out = [F.when(c("_hit"), assignments[x]).otherwise(c(x)).alias(x) if x in assignments else c(x)
           for x in target.columns]
    return j.select(*out)


def touch(df: DataFrame, old_prefix: str, tracked: Sequence[str], as_of: str, col: str = "updated_at") -> DataFrame:
    changed = F.lit(False)
    for t in tracked:
        changed = changed | ~c(t).eqNullSafe(c(f"{old_prefix}{t}"))
    return df.withColumn(col, F.when(changed, F.lit(as_of).cast("timestamp_ntz")).otherwise(c(col)))


def new_version_path(spark: SparkSession, table: str) -> str:
    return os.path.join(checkpoint_dir(spark), "tables", table, f"v-{uuid.uuid4().hex}")


def _log_path(spark: SparkSession, table: str) -> str:
    return os.path.join(checkpoint_dir(spark), "tables", table, "_log")


def apply(df: DataFrame, table: str, mode: str = "overwrite") -> str:
    """Write the previewed state to a fresh folder and point the table at it.

    ``overwrite`` (A5: truncate and reload) makes the folder the whole table, ``append`` (A8) adds
    it. The log row that says so is written after the data, so a reader of ``current`` sees the
    state before or after, never a part. Returns the path written.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode!r}")
    spark = df.sparkSession
    path = new_version_path(spark, table)
    df.write.mode("errorifexists").parquet(path)
    row = spark.range(1).select(F.lit(time.time_ns()).alias("at"), F.lit(mode).alias("mode"), F.lit(path).alias("path"))
    row.write.mode("append").parquet(_log_path(spark, table))
    return path


def current(spark: SparkSession, table: str) -> DataFrame:
    """The table as of its log: the folder of the last overwrite and those appended since."""
    log = spark.read.schema("at long, mode string, path string").parquet(_log_path(spark, table))
    since = log.filter(c("mode") == "overwrite").agg(F.max("at").alias("at")).first()["at"]
    held = log if since is None else log.filter(c("at") >= since)
    return spark.read.parquet(*[r["path"] for r in held.orderBy("at").collect()])  # a row for each write since
