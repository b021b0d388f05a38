"""Versions as of a time: validity intervals of a write log, and the as-of join with facts.

A write holds for its key until the key's next write. ``as_of_join`` is an equi-join on (key, time
bucket) with the time condition on top, so a key with a third of all facts is spread over the buckets of
its history; a window over each fact's key, which a plain as-of by union needs, would put them
all in one task. A bucket gets the interval that holds when it begins, found by a window over the
key's occupied buckets and writes, and those that begin in it. Only buckets that hold facts exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


def validity(log: DataFrame, key: str, since: str, payload: list[str]) -> DataFrame:
    """(key, since, until, payload) of ``log``: each write up to the key's next; an open end is null.

    Of writes of one key and time the largest payload counts; null keys and times are left out.
    """
    one = (log.filter(c(key).isNotNull() & c(since).isNotNull()).groupBy(key, since)
           .agg(F.max(F.struct(*payload)).alias("_p")))
    return one.select(key, since, F.expr(f"lead({since}) over (partition by {key} order by {since})").alias("until"),
                      *[c(f"_p.{p}").alias(p) for p in payload])


def _bucket(at: Column, days: int) -> Column:
    return F.floor(F.date_diff(F.to_date(at), F.lit("1970-01-01").cast("date")) / days).cast("int")


def as_of_join(facts: DataFrame, held: DataFrame, key: str, at: str, since: str, days: int = 30) -> DataFrame:
    """Every row of ``facts`` with ``since``, ``until`` and the payload of the interval that holds at ``at``.

    ``held`` comes from ``validity``; its columns but the key must not stand in ``facts``. Without an interval, with a null
    key or a null time, they are null. Repeated facts each keep their row.
    """
    kept = [x for x in held.columns if x != key]
    facts = facts.withColumn("_b", _bucket(c(at), days))
    entry = F.struct(*kept)
    kind = held.select(entry.alias("e")).schema["e"].dataType
    start = F.date_add(F.lit("1970-01-01").cast("date"), c("_b") * days).cast(held.schema[since].dataType)
    occupied = (facts.filter(c(key).isNotNull() & c("_b").isNotNull()).select(key, "_b").distinct()
                .join(held.select(key).distinct(), key, "left_semi"))
    line = (occupied.select(key, start.alias("_at"), "_b", F.lit(None).cast(kind).alias("_e"))
            .unionByName(held.select(key, c(since).alias("_at"), F.lit(None).cast("int").alias("_b"), entry.alias("_e"))))
    # at equal times the bucket comes first: that write begins inside it
    last = f"last(_e, true) over (partition by {key} order by _at, _b is null rows between unbounded preceding and current row)"
    carried = line.select(key, "_at", "_b", F.expr(last).alias("_e")).filter(
        c("_b").isNotNull() & c("_e").isNotNull() & (c("_e.until").isNull() | (c("_e.until") > c("_at"))))
    dealt = carried.select(key, "_b", "_e.*").unionByName(held.withColumn("_b", _bucket(c(since), days)).select(key, "_b", *kept))
    f, d = facts.alias("f"), dealt.alias("d")
    on = ((c(f"f.{key}") == c(f"d.{key}")) & (c("f._b") == c("d._b")) & (c(f"d.{since}") <= c(f"f.{at}"))
          & (c("d.until").isNull() | (c(f"f.{at}") < c("d.until"))))
    return f.join(d, on, "left").select(*[c(f"f.{x}") for x in facts.columns if x != "_b"], *[c(f"d.{x}") for x in kept])
