"""Keyed state with event-time timers: trust that falls as corrections arrive (J6, K17) and retries
that come due by themselves (J8, K14).

Both are ``transformWithState`` operators over RocksDB state: one key's state is what its own future
needs and nothing more, timers remove or fire it when the watermark passes, and a restarted query goes
on from its checkpoint. Results don't depend on how rows fall into batches.

* ``trust_stream``: per sender domain, corrections counted by day for the window (the exact times are
  kept by day too, so that only the oldest day is looked into), and per sender its corrections. Every
  change writes the domain's senders with their lowered confidences; a timer drops days that the
  window has left.
* ``retry_stream``: per message, the last outcome and the time of the next attempt. Success with a
  body and a fatal status end it; a timer gives the due row when the watermark reaches it, and longer
  waits after each failure (``backoff``; a ``Retry-After`` wins).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from triage.functions.features import match_address
from triage.session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

c = F.col

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 86_400_000_000  # microseconds


def rocksdb_state(spark: SparkSession) -> None:
    """State of many variables needs the RocksDB store; one that the cluster names is left as it is."""
    if "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


# --- J6 / K17: trust ---------------------------------------------------------------

TRUST = "sender_key string, confidence_score int, user_corrections int, corrections_30d bigint, version bigint"


class Trust(StatefulProcessor):
    """Input rows: domain, at, sender_key (null: a correction of the domain; else one of that sender),
    confidence_score and user_corrections of the sender before any of them."""

    def __init__(self, days: int, threshold: int, step: int, floor: int):
        self.days, self.threshold, self.step, self.floor = days, threshold, step, floor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "day long", "n long")
        self.times = handle.getMapState("times", "day long", "at array<bigint>")
        self.senders = handle.getMapState("senders", "sender_key string", "confidence int, corrections int, n int")
        self.clock = handle.getValueState("clock", "latest long, version long")

    def _drop(self, before: int) -> None:
        """Days that lie wholly outside of the window."""
        for (day,) in [k for k in self.counts.keys() if (k[0] + 1) * DAY <= before]:
            self.counts.removeKey((day,))
            self.times.removeKey((day,))

    def _in_window(self, start: int) -> int:
        """Corrections later than ``start``."""
        n = 0
        for (day,), (k,) in self.counts.iterator():
            if day > start // DAY:
                n += k
            elif day == start // DAY:
                n += sum(t > start for t in self.times.getValue((day,))[0])
        return n

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        latest, version = self.clock.get() if self.clock.exists() else (0, 0)
        new: dict[int, list[int]] = {}
        hits: dict[str, tuple] = {}
        for part in rows:
            for at, sender, confidence, corrections in zip(part["at"], part["sender_key"], part["confidence_score"], part["user_corrections"]):
                t = pd.Timestamp(at).value // 1000
                latest = max(latest, t)
                if sender is None or pd.isna(sender):
                    new.setdefault(t // DAY, []).append(t)
                else:
                    hits[sender] = (int(confidence), int(corrections), hits.get(sender, (0, 0, 0))[2] + 1)
        start = latest - self.days * DAY
        for day, some in new.items():
            if (day + 1) * DAY <= start:
                continue  # too late to count
            known = list(self.times.getValue((day,))[0]) if self.times.containsKey((day,)) else []
            self.times.updateValue((day,), (known + some,))
            self.counts.updateValue((day,), (len(known) + len(some),))
            self.handle.registerTimer(((day + 1 + self.days) * DAY) // 1000)
        self._drop(start)
        for sender, (confidence, corrections, n) in hits.items():
            if self.senders.containsKey((sender,)):
                confidence, corrections, before = self.senders.getValue((sender,))
                n += before
            self.senders.updateValue((sender,), (confidence, corrections, n))
        version += 1
        self.clock.update((latest, version))
        recent = self._in_window(start)
        out = [(s, max(conf - self.step * n, self.floor) if recent >= self.threshold else conf, corr + n, recent, version)
               for (s,), (conf, corr, n) in self.senders.iterator()]
        yield pd.DataFrame(out, columns=["sender_key", "confidence_score", "user_corrections", "corrections_30d", "version"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._drop(expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.days * DAY)
        yield pd.DataFrame({"sender_key": pd.Series(dtype=str), "confidence_score": pd.Series(dtype="int32"),
                            "user_corrections": pd.Series(dtype="int32"), "corrections_30d": pd.Series(dtype="int64"),
                            "version": pd.Series(dtype="int64")})

    def close(self) -> None:
        pass


def trust_rows(corrections: DataFrame, senders: DataFrame) -> DataFrame:
    """Input of ``Trust`` from corrections (from_address, from_domain, created_at; a null address only
    counts for its domain) and the sender table: a row for the domain and one for each sender hit."""
    none_s, none_i = F.lit(None).cast("string"), F.lit(None).cast("int")
    at = c("created_at").cast("timestamp").alias("at")
    rows = corrections.select(at, match_address(c("from_address")).alias("address"), F.lower("from_domain").alias("domain"),
                              c("from_address").isNotNull().alias("fresh"))
    # one row a sender key that may be hit, so the sender table is joined once
    asked = rows.select("at", "domain", F.explode(F.array(
        F.struct(none_s.alias("key"), F.lit("domain").alias("by")),
        F.struct(F.when(c("fresh"), c("address")).alias("key"), F.lit("address").alias("by")),
        F.struct(F.when(c("fresh"), c("domain")).alias("key"), F.lit("sender domain").alias("by")))).alias("k")).select("at", "domain", "k.*")
    s = senders.select("sender_key", "sender_domain", "confidence_score", "user_corrections", c("sender_address").isNull().alias("is_domain"))
    hit = asked.filter("key is not null").join(s, c("key") == c("sender_key")).filter((c("by") == "address") | c("is_domain"))
    counted = asked.filter("by = 'domain' and domain is not null").select(
        "domain", "at", none_s.alias("sender_key"), none_i.alias("confidence_score"), none_i.alias("user_corrections"))
    return counted.unionByName(hit.select(c("sender_domain").alias("domain"), "at", "sender_key", "confidence_score", "user_corrections"))


def trust_stream(corrections: DataFrame, senders: DataFrame, days: int = 30, threshold: int = 5, step: int = 5, floor: int = 30,
                 late: str = "35 days") -> DataFrame:
    """Streaming corrections -> updated senders (sender_key, confidence_score, user_corrections,
    corrections_30d, version); the greatest version of a sender holds. Rows up to ``late`` count."""
    rocksdb_state(corrections.sparkSession)
    rows = trust_rows(corrections.withColumn("created_at", c("created_at").cast("timestamp")).withWatermark("created_at", late), senders)
    return rows.groupBy("domain").transformWithStateInPandas(
        Trust(days, threshold, step, floor), outputStructType=TRUST, outputMode="Update", timeMode="EventTime")


# --- J8 / K14: retries ---------------------------------------------------------------

DUE = "message_id string, last_body_fetch_status string, retry_at timestamp, attempts int"


class Retry(StatefulProcessor):
    """Input rows: message_id, at, status (as ``last_body_fetch_status``), wait (seconds or null)."""

    def __init__(self, first: int, empty: int, backoff: float, longest: int):
        self.first, self.empty, self.backoff, self.longest = first, empty, backoff, longest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("retry", "status string, retry_at long, attempts int, seen long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        news = sorted(((pd.Timestamp(at).value // 1_000_000, status, wait) for part in rows
                       for at, status, wait in zip(part["at"], part["status"], part["wait"]) if status is not None), key=lambda x: x[:2])
        for at, status, wait in news:
            attempts, before = 0, None
            if self.state.exists():
                _, before, attempts, seen = self.state.get()
                if at < seen:
                    continue  # an older outcome says nothing new
            if before is not None and before >= 0:
                self.handle.deleteTimer(before)
            if status == "ok" or status.startswith("fatal"):
                self.state.update((status, -1, attempts + 1, at))
                continue
            if status == "empty":
                seconds = self.empty
            elif wait is not None and not pd.isna(wait):
                seconds = wait
            else:
                seconds = min(self.first * self.backoff ** attempts, self.longest)
            due = at + int(seconds * 1000)
            self.state.update((status, due, attempts + 1, at))
            self.handle.registerTimer(due)
        yield pd.DataFrame({"message_id": pd.Series(dtype=str), "last_body_fetch_status": pd.Series(dtype=str),
                            "retry_at": pd.Series(dtype="datetime64[ns]"), "attempts": pd.Series(dtype="int32")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        status, due, attempts, seen = self.state.get()
        if due == expiredTimerInfo.getExpiryTimeInMs():
            self.state.update((status, -1, attempts, seen))  # handed out; the next outcome decides on
            yield pd.DataFrame({"message_id": [key[0]], "last_body_fetch_status": [status],
                                "retry_at": [pd.Timestamp(due, unit="ms")], "attempts": [attempts]})

    def close(self) -> None:
        pass


def retry_stream(outcomes: DataFrame, late: str = "0 seconds", first: int = 120, empty: int = 7200, backoff: float = 2.0,
                 longest: int = 86_400) -> DataFrame:
    """Streaming outcomes (message_id, at, status, wait) -> rows whose retry has come due.

    ``first``: seconds to the first retry without a ``Retry-After``, times ``backoff`` after each
    further failure up to ``longest``; ``empty``: seconds after an empty body. A row without a status
    only moves the clock.
    """
    rocksdb_state(outcomes.sparkSession)
    return outcomes.withWatermark("at", late).groupBy("message_id").transformWithStateInPandas(
        Retry(first, empty, backoff, longest), outputStructType=DUE, outputMode="Append", timeMode="EventTime")


def started(stream: DataFrame, sink, name: str, mode: str):
    """Run what has landed through ``sink`` (a foreachBatch function), then stop; resumes by ``name``."""
    at = os.path.join(checkpoint_dir(stream.sparkSession), "streams", name)
    return (stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", at)
            .trigger(availableNow=True).start())
