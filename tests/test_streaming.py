"""Streaming jobs: the same rows in one batch and in many batches."""

import os
import tempfile

from pyspark.sql import functions as F

from triage.streaming import jobs
from triage.streaming.batch_twins import delta_merge, mail_changes
from tests.conftest import rows


def _land_parquet(df, folder, parts):
    """Write ``df`` as ``parts`` separate files (successive arrivals)."""
    df = df.withColumn("_p", F.abs(F.hash("message_id")) % parts)
    for p in range(parts):
        df.filter(F.col("_p") == p).drop("_p").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(folder, f"arrival={p:03d}"))


def _run_pull(spark, events, parts):
    landing = tempfile.mkdtemp(prefix="triage-land-")
    table = tempfile.mkdtemp(prefix="triage-table-")
    ch = mail_changes(events)
    # each arrival is its own folder so the file source sees new files per batch
    df = ch.withColumn("_p", F.abs(F.hash("message_id", "subject")) % parts)
    for p in range(parts):
        df.filter(F.col("_p") == p).drop("_p").write.mode("overwrite").parquet(
            os.path.join(landing, f"part{p:03d}"))
    stream = spark.readStream.schema(jobs.MAIL_CHANGE).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(landing)
    ckpt = tempfile.mkdtemp(prefix="triage-ck-")
    sink = jobs.KeyedUpsert(table, ["message_id"], "last_modified")
    q = (stream.writeStream.foreachBatch(sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return sink.read_current(spark)


def test_incremental_pull_same_in_one_and_many_batches(spark, fx001):
    one = _run_pull(spark, fx001.events, 1)
    many = _run_pull(spark, fx001.events, 4)
    twin = delta_merge(fx001)
    cols = ["message_id", "user_upn", "subject", "from_address", "last_modified"]
    assert rows(one.select(*cols)) == rows(many.select(*cols)) == rows(twin.select(*cols))


def test_upsert_sink_replay_is_idempotent(spark, fx001):
    table = tempfile.mkdtemp(prefix="triage-table-")
    sink = jobs.KeyedUpsert(table, ["message_id"], "last_modified")
    ch = mail_changes(fx001.events)
    older = ch.filter(F.col("subject").endswith("v0"))
    sink(ch, 0)
    first = rows(sink.read_current(spark))
    sink(ch, 0)           # the same batch delivered again after a failure
    sink(older, 1)        # late, older versions arrive in a later batch
    assert rows(sink.read_current(spark)) == first
    assert rows(sink.read_current(spark)) == rows(delta_merge(fx001))


def test_notification_stream_dedupes_within_watermark(spark, fx001):
    landing = tempfile.mkdtemp(prefix="triage-notes-")
    n = fx001.notification.withColumn("received_at", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))
    n.write.mode("overwrite").json(os.path.join(landing, "a"))
    deduped = jobs.notification_stream(spark, os.path.join(landing, "a"))
    q = deduped.writeStream.format("memory").queryName("notes_out").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.sql("select count(*), count(distinct message_id) from notes_out").first()
    from triage.plans.ingest import notification_rows
    want = notification_rows(fx001.notification)
    assert got[1] == want.select("message_id").distinct().count()
    assert got[0] == want.select("message_id", "changeType").distinct().count()


def test_corrections_window_stream(spark, fx001):
    landing = tempfile.mkdtemp(prefix="triage-fb-")
    fx001.feedback.write.mode("overwrite").json(os.path.join(landing, "a"))
    agg = jobs.corrections_window_stream(spark, os.path.join(landing, "a"))
    q = agg.writeStream.outputMode("complete").format("memory").queryName("fb_out") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    total = spark.sql("select sum(corrections) from fb_out").first()[0]
    # each correction falls into 30 sliding daily windows
    assert total == 30 * fx001.feedback.count()


def test_gate_stream_routes_like_its_twin(spark, fx001):
    from triage.streaming.batch_twins import gate_routing
    landing = tempfile.mkdtemp(prefix="triage-gate-")
    n = fx001.notification.withColumn("received_at", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))
    n.write.mode("overwrite").json(os.path.join(landing, "a"))
    out = tempfile.mkdtemp(prefix="triage-gate-out-")

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    q = jobs.gate_stream(spark, os.path.join(landing, "a"), fx001.decision, sink,
                         name=os.path.basename(out))   # a fresh checkpoint per test run
    q.awaitTermination()
    got = spark.read.parquet(out).select("message_id", "route")
    assert rows(got.distinct()) == rows(gate_routing(fx001))  # a row for each change of a message


def test_daily_digest_stream_matches_batch(spark, fx001):
    landing = tempfile.mkdtemp(prefix="triage-dec-")
    fx001.decision.write.mode("overwrite").parquet(landing)
    dec = spark.readStream.schema(fx001.decision.schema).parquet(landing)
    q = (jobs.daily_digest_stream(dec).writeStream.outputMode("complete").format("memory")
         .queryName("digest_out").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("select to_date(window.start) as day, primary_category, decisions from digest_out")
    want = fx001.decision.groupBy(F.to_date("decided_at").alias("day"), "primary_category").agg(
        F.count(F.lit(1)).alias("decisions"))
    assert rows(got) == rows(want)


def _pull(spark, landing, table, ckpt):
    stream = spark.readStream.schema(jobs.MAIL_CHANGE).parquet(landing)
    sink = jobs.KeyedUpsert(table, ["message_id"], "last_modified")
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    return sink


def _change(spark, mid, subject, at):
    return spark.createDataFrame([(mid, "u", subject, "a@b", at)], "message_id string, user_upn string, subject string, from_address string, at string") \
        .select("message_id", "user_upn", "subject", "from_address", F.col("at").cast("timestamp_ntz").alias("last_modified"))


def test_a_lost_bookmark_loses_no_rows(spark):
    """Batch ids start again under a new checkpoint; earlier folders stay."""
    one, two, table = (tempfile.mkdtemp(prefix="triage-reset-") for _ in range(3))
    _change(spark, "a", "old", "2024-01-01 00:00:00").write.mode("overwrite").parquet(one)
    _pull(spark, one, table, tempfile.mkdtemp())
    _change(spark, "b", "new", "2024-01-02 00:00:00").write.mode("overwrite").parquet(two)
    sink = _pull(spark, two, table, tempfile.mkdtemp())
    assert rows(sink.read_current(spark).select("message_id", "subject")) == [("a", "old"), ("b", "new")]


def test_compaction_is_read_and_later_batches_win(spark):
    land, table = tempfile.mkdtemp(prefix="triage-comp-"), tempfile.mkdtemp(prefix="triage-comp-")
    _change(spark, "a", "v1", "2024-01-01 00:00:00").write.mode("overwrite").parquet(land)
    ckpt = tempfile.mkdtemp()
    sink = _pull(spark, land, table, ckpt)
    base = sink.compact(spark)
    assert rows(spark.read.parquet(base).select("message_id", "subject")) == [("a", "v1")]
    assert any(base in f for f in sink.read_current(spark).inputFiles())
    _change(spark, "a", "v2", "2024-01-03 00:00:00").write.mode("append").parquet(land)
    sink = _pull(spark, land, table, ckpt)
    assert rows(sink.read_current(spark).select("message_id", "subject")) == [("a", "v2")]
    sink.compact(spark)
    assert rows(sink.read_current(spark).select("message_id", "subject")) == [("a", "v2")]
    assert str(sink.watermark(spark)).startswith("2024-01-03")


def test_reset_on_expiry_pulls_from_the_watermark(spark):
    land, table = tempfile.mkdtemp(prefix="triage-exp-"), tempfile.mkdtemp(prefix="triage-exp-")
    _change(spark, "a", "v1", "2024-01-01 00:00:00").unionByName(_change(spark, "b", "v1", "2024-02-01 00:00:00")).write.mode("overwrite").parquet(land)
    sink = _pull(spark, land, table, tempfile.mkdtemp())
    again = tempfile.mkdtemp(prefix="triage-exp-")
    name = os.path.basename(again)
    jobs.incremental_pull(spark, land, again, name=name, since=sink.watermark(spark)).awaitTermination()
    got = jobs.KeyedUpsert(again, ["message_id"], "last_modified").read_current(spark)
    assert rows(got.select("message_id")) == [("b",)]


def test_created_then_updated_within_the_hour_gives_both(spark):
    landing = tempfile.mkdtemp(prefix="triage-notes-")
    note = lambda e, change: (e, '{"value":[{"changeType":"%s","clientState":"ok","resourceData":{"id":"m"}}]}' % change, "2024-01-31 00:00:00")
    spark.createDataFrame([note(1, "created"), note(2, "updated"), note(3, "created")], "event_id long, payload string, received_at string") \
        .write.mode("overwrite").json(os.path.join(landing, "a"))
    q = jobs.notification_stream(spark, os.path.join(landing, "a")).writeStream.format("memory").queryName("notes_both") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.sql("select message_id, changeType from notes_both")) == [("m", "created"), ("m", "updated")]
