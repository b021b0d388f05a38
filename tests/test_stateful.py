"""Stateful streams against their batch twins: any order and cut of the rows gives the same end."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from triage import AS_OF
from triage.plans.sync import sender_learning, state_diff_df
from triage.plans.work import fetch_outcome_df, retry_due
from triage.streaming import jobs
from triage.streaming.jobs import KeyedUpsert
from triage.streaming.stateful import Trust, retry_stream, started, trust_stream

c = F.col


def land(df, parts, seed):
    """``df`` as ``parts`` files in a shuffled order."""
    folder = tempfile.mkdtemp(prefix="triage-land-")
    df = df.withColumn("_p", F.pmod(F.xxhash64(*df.columns, F.lit(seed)), F.lit(parts))).checkpoint()
    for p in range(parts):
        df.filter(c("_p") == p).drop("_p").coalesce(1).write.parquet(os.path.join(folder, f"part{p:03d}"))
    return folder


def stream_of(spark, folder, schema, per=1):
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per).parquet(folder)


@pytest.mark.parametrize(("parts", "seed"), [(1, 0), (4, 1)])
def test_trust_equals_sender_learning(spark, fx001, parts, seed):
    new = state_diff_df(fx001).select("from_address", "from_domain", F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"))
    old = fx001.feedback.select(F.lit(None).cast("string").alias("from_address"), "from_domain", "created_at")
    corrections = new.unionByName(old)
    folder = land(corrections, parts, seed)
    table = tempfile.mkdtemp(prefix="triage-table-")
    sink = KeyedUpsert(table, ["sender_key"], "version")
    senders = fx001.sender.checkpoint()
    started(trust_stream(stream_of(spark, folder, corrections.schema), senders), sink, os.path.basename(table), "update").awaitTermination()
    got = sink.read_current(spark).select("sender_key", "confidence_score", "user_corrections", "corrections_30d")
    want = sender_learning(fx001)
    assert rows(got) == rows(want.select(got.columns)) and not want.isEmpty()


def outcomes(spark, fx):
    f = fetch_outcome_df(fx).select("message_id", F.lit(AS_OF).cast("timestamp").alias("at"), c("last_body_fetch_status").alias("status"),
                                    c("retry_after_seconds").cast("double").alias("wait"))
    return f


@pytest.mark.parametrize("check", ["2024-01-31 00:01:00", "2024-01-31 01:00:00", "2024-01-31 03:00:00"])
def test_retries_come_due(spark, fx001, check):
    first = outcomes(spark, fx001)
    tick = spark.createDataFrame([("", dt.datetime.fromisoformat(check) + dt.timedelta(milliseconds=1))], "message_id string, at timestamp") \
        .withColumns({"status": F.lit(None).cast("string"), "wait": F.lit(None).cast("double")})
    folder = tempfile.mkdtemp(prefix="triage-land-")
    first.coalesce(1).write.parquet(os.path.join(folder, "a"))
    tick.coalesce(1).write.parquet(os.path.join(folder, "b"))
    got, name = [], os.path.basename(folder)
    stream = retry_stream(stream_of(spark, folder, first.schema))
    started(stream, lambda b, i: got.extend(tuple(r) for r in b.collect()), name, "append").awaitTermination()
    want = [tuple(r) for r in retry_due(fx001, check).collect()]
    assert sorted((m, s, t.replace(tzinfo=None)) for m, s, t, _ in got) == sorted(want) and want
    assert {a for *_, a in got} == {1}


def test_backoff_grows_and_fatal_stops(spark):
    t0 = dt.datetime(2024, 1, 31)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    steps = [[("a", at(0), "retryable:500", None), ("b", at(0), "retryable:503", None), ("d", at(0), "empty", None)],
             [("", at(121), None, None)],
             [("a", at(130), "retryable:500", None), ("b", at(130), "fatal:404", None)],
             [("", at(200), None, None)], [("", at(371), None, None)],
             [("a", at(380), "retryable:429", 7.0), ("a", at(1), "ok", None)], [("", at(388), None, None)],
             [("a", at(400), "ok", None)], [("", at(90_000), None, None)]]
    folder, schema = tempfile.mkdtemp(prefix="triage-land-"), "message_id string, at timestamp, status string, wait double"
    got = []
    for i, step in enumerate(steps):  # a restart after each: state and timers come from the checkpoint
        spark.createDataFrame(step, schema).coalesce(1).write.parquet(os.path.join(folder, f"s{i}"))
        stream = retry_stream(stream_of(spark, folder, schema))
        started(stream, lambda b, _: got.extend(tuple(r) for r in b.collect()), os.path.basename(folder), "append").awaitTermination()
    seen = [(m, s, int((t.replace(tzinfo=None) - t0).total_seconds()), n) for m, s, t, n in got]
    assert sorted(seen) == [("a", "retryable:429", 387, 3), ("a", "retryable:500", 120, 1), ("a", "retryable:500", 370, 2),
                            ("b", "retryable:503", 120, 1), ("d", "empty", 7200, 1)]


def test_window_looks_into_the_oldest_day_only():
    class Map(dict):
        def iterator(self):
            return iter(self.items())

        def getValue(self, k):
            return self[k]

    p = Trust(30, 5, 5, 30)
    day = 86_400_000_000
    p.counts, p.times = Map({(3,): (2,), (4,): (7,), (1,): (9,)}), Map({(3,): ([3 * day + 5, 3 * day + 9],)})
    assert p._in_window(3 * day + 5) == 8 and p._in_window(3 * day) == 9 and p._in_window(4 * day - 1) == 7


def test_gate_counts_decisions_that_come_later(spark):
    """Stream-stream gate: shuffled arrivals, repeats, several decisions; same routes as over the whole tables."""
    t0 = dt.datetime(2024, 1, 10)
    at = lambda h: t0 + dt.timedelta(hours=h)
    notes = [(f"m{i}", "updated", at(2 + i % 5)) for i in range(40)] + [(f"m{i}", "updated", at(2 + i % 5)) for i in range(0, 40, 4)]
    made = [(f"m{i}", at(h)) for i in range(40) for h in ((1,) if i % 3 == 0 else (0, 1) if i % 3 == 1 and i % 2 else (40,) if i % 5 == 0 else ())]
    made += [("m2", t0 - dt.timedelta(days=45))]
    n_schema, d_schema = "message_id string, changeType string, received_at timestamp", "message_id string, decided_at timestamp"
    n, d = spark.createDataFrame(notes, n_schema), spark.createDataFrame(made, d_schema)
    end = at(24 * 60)
    n_dir, d_dir = tempfile.mkdtemp(prefix="triage-land-"), tempfile.mkdtemp(prefix="triage-land-")
    n.filter("hour(received_at) < 4").coalesce(1).write.parquet(f"{n_dir}/a")  # notes first: their decisions land after them
    d.filter("message_id < 'm2'").coalesce(1).write.parquet(f"{d_dir}/a")
    got, name = [], os.path.basename(n_dir)

    def run_once():
        notes_in = stream_of(spark, n_dir, n.schema, 10).withWatermark("received_at", "1 day")
        out = jobs.gate_live(notes_in, stream_of(spark, d_dir, d.schema, 10), late="2 days")
        started(out, lambda b, _: got.extend((r.message_id, r.route) for r in b.collect()), name, "append").awaitTermination()

    run_once()
    n.filter("hour(received_at) >= 4").coalesce(1).write.parquet(f"{n_dir}/b")
    d.filter("message_id >= 'm2'").coalesce(1).write.parquet(f"{d_dir}/b")
    run_once()
    spark.createDataFrame([("end", "updated", end)], n_schema).coalesce(1).write.parquet(f"{n_dir}/c")
    spark.createDataFrame([("other", end)], d_schema).coalesce(1).write.parquet(f"{d_dir}/c")
    run_once()
    run_once()
    days = dt.timedelta(days=30)
    want = {m: "sync_only" if any(x == m and r - days <= w <= r for x, w in made) else "classify" for m, _, r in notes}
    assert sorted(x for x in got if x[0] != "end") == sorted(want.items()) and set(want.values()) == {"sync_only", "classify"}
