"""Operator 10 [native]: URL filters by a temporal list join.

A filter list is a log of dated entries (key, action, since): from its date on, an entry holds for
its key until the key's next entry. So the log becomes validity intervals [since, until), and each
capture is joined as of its fetch time with the intervals of the keys its URL has: the host and
every parent domain down to the last label (``example.org`` and ``org`` cover ``a.example.org``), and
host with path prefixes (``a.example.org/x/``), of any number of labels and folders. The most specific active entry decides: the longest path, then the longest
host. Actions: ``block`` drops the capture, ``allow`` keeps it, ``remove`` ends the entry before.

The join is an equi-join on (key, time bucket) with the as-of condition on top, so a host with a
third of all captures is spread over buckets. A bucket that captures of a key occupy gets the
interval that holds when it begins (the last entry before it, by a window over the key's occupied buckets and
entries) and those that begin in it; a bucket without captures costs nothing, so a stray date
doesn't multiply open intervals. Intervals of a key don't overlap, so a capture meets one per key at
most. A URL's keys go no deeper than the list's deepest entry: longer ones can't meet any. Entries
enter as a log of any size; nothing but one row of depths is broadcast by hand.

Edge cases: entries with a null key, date or action are left out; of entries of equal key and date the
smaller action counts, repeated ones once; a capture with a null or unparsable URL or null time
meets no list and is kept (``verdict`` none); host names compare in lower case without a final dot
or ``www.``, paths as written; query and fragment don't count; repeated captures each get a row; other columns are not read;
empty tables: no captures give no rows, no entries keep every capture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = 30 * 86400  # seconds of a time bucket


def host_of(url) -> Column:
    """Lower-case host without credentials, port, final dot and ``www.``; no host: null."""
    h = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.nullif(F.regexp_replace(F.regexp_replace(h, r"\.+$", ""), r"^www\.", ""), F.lit(""))


def path_of(url) -> Column:
    return F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)


def keys_of(host: str, path: str, folders: str, labels: str) -> Column:
    """Keys that a URL answers to, with their rank: path folders first, then the longer domain.

    ``folders``, ``labels``: columns with the most slashes and host labels that a key may have.
    """
    l, p = f"split({host}, '[.]')", f"split({path}, '/')"
    domains = f"""transform(sequence(greatest(1, least(size({l}), size({l}) - {labels} + 1)), size({l})),
        i -> struct(array_join(slice({l}, i, size({l})), '.') as key, i as rank))"""
    prefixes = f"""transform(filter(sequence(greatest(1, least(size({p}) - 1, {folders})), 1, -1), i -> i < size({p}) and i <= {folders}),
        i -> struct(concat({host}, array_join(slice({p}, 1, i), '/'), '/') as key, -i as rank))"""
    return F.expr(f"concat({prefixes}, {domains})")


def intervals(entries: DataFrame) -> DataFrame:
    """(key, action, since, until) from ``entries(key, action, since)``; an open end is null."""
    host = F.substring_index("key", "/", 1)  # paths keep their case
    e = entries.select(F.concat(F.lower(host), F.expr("substr(key, length(substring_index(key, '/', 1)) + 1)")).alias("key"), "action", F.col("since").cast("timestamp").alias("since")) \
        .filter("key is not null and since is not null and action is not null")
    e = e.groupBy("key", "since").agg(F.min("action").alias("action"))  # one entry a key and date
    # one key's dates only, each once: the log of a single host
    nxt = F.expr("lead(since) over (partition by key order by since)")
    return e.withColumn("until", nxt).filter("action <> 'remove'").select("key", "action", "since", "until")


def judge(captures: DataFrame, entries: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(page_id, host, fetched, verdict, key, since) of every row of ``captures(page_id, url, fetched)``.

    verdict: block, allow, or none without an active entry; key, since: the entry that decided.
    """
    held = intervals(entries)
    c = captures.select(F.col("page_id").cast("long"), F.col("url"), F.col("fetched").cast("timestamp").alias("fetched"))
    # a capture's name: equal captures have equal verdicts
    c = c.select(F.coalesce("page_id", F.lit(-1)).alias("id"), F.xxhash64("url", "fetched").alias("row"), "page_id", "fetched",
                 host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    deepest = held.agg(  # one row
        F.coalesce(F.max(F.expr("size(split(key, '/')) - 1")), F.lit(0)).alias("folders"),
        F.coalesce(F.max(F.expr("size(split(substring_index(key, '/', 1), '[.]'))")), F.lit(1)).alias("labels"))
    probe = c.filter("host is not null and fetched is not null").join(F.broadcast(deepest)).select(
        "id", "row", "fetched", F.explode_outer(keys_of("host", "path", "folders", "labels")).alias("k")).select(
        "id", "row", "fetched", "k.key", "k.rank", F.floor(F.unix_timestamp("fetched") / bucket).alias("b"))
    entry = F.struct("action", "since", "until")
    occupied = probe.select("key", "b").distinct().join(held.select("key").distinct(), "key", "left_semi")
    marks = occupied.select("key", F.timestamp_seconds(F.col("b") * bucket).alias("at"), "b", F.lit(None).cast(
        "struct<action:string,since:timestamp,until:timestamp>").alias("e"))
    line = marks.unionByName(held.select("key", F.col("since").alias("at"), F.lit(None).cast("long").alias("b"), entry.alias("e")))
    # one key's occupied buckets and dates; at equal times the bucket first, as that entry begins inside it
    before = F.expr("last(e, true) over (partition by key order by at, b is null rows between unbounded preceding and current row)")
    carried = line.select("key", "at", "b", before.alias("e")).filter("b is not null and e is not null and (e.until is null or e.until > at)") \
        .select("key", "b", "e.action", "e.since", "e.until")
    begun = held.select("key", F.floor(F.unix_timestamp("since") / bucket).alias("b"), "action", "since", "until")
    dealt = carried.unionByName(begun)
    met = probe.join(dealt, ["key", "b"]).filter("since <= fetched and (until is null or fetched < until)")
    best = met.groupBy("id", "row").agg(F.min(F.struct("rank", "action", "key", "since")).alias("m"))
    return c.join(best, ["id", "row"], "left").select(
        "page_id", "host", "fetched", F.coalesce("m.action", F.lit("none")).alias("verdict"),
        F.col("m.key").alias("key"), F.col("m.since").alias("since"))
