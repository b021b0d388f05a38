"""Structured Streaming jobs.

The reference polls and receives webhooks; here landed files are the stream. Every job:

* reads a folder with ``readStream`` and an explicit schema (file source, exactly-once),
* keeps its checkpoint under the session's shared ``spark.checkpoint.dir`` (survives executor
  and driver loss; restarting resumes from the last committed batch),
* writes through ``foreachBatch`` with an idempotent, merge-on-read upsert keyed by the natural
  key: a batch writes only its own rows, and a replayed batch overwrites itself.

``trigger(availableNow=True)`` processes what has landed and stops, which is how a scheduler
runs the incremental pull (J3); a long-running deployment uses a processing-time trigger.
Watermarks need an instant-typed event time, so event-time columns are ``TIMESTAMP`` (UTC
session zone); wall-clock ``TIMESTAMP_NTZ`` inputs are cast on the way in.
"""

from __future__ import annotations

import os
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triage.plans.ingest import NOTIFICATION
from triage.session import checkpoint_dir

c = F.col

NOTIFICATION_FILE = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("payload", T.StringType()),
                                  T.StructField("received_at", T.TimestampType())])
MAIL_CHANGE = T.StructType([
    T.StructField("message_id", T.StringType()), T.StructField("user_upn", T.StringType()),
    T.StructField("subject", T.StringType()), T.StructField("from_address", T.StringType()),
    T.StructField("last_modified", T.TimestampNTZType())])
FEEDBACK = T.StructType([T.StructField("message_id", T.StringType()), T.StructField("from_domain", T.StringType()),
                         T.StructField("feedback_type", T.StringType()),
                         T.StructField("created_at", T.TimestampType())])


def _ckpt(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name)


# --- J1 / J2: notifications --------------------------------------------------------

def notification_stream(spark: SparkSession, landing: str, client_state: str = "ok",
                        dedupe_window: str = "1 hour") -> DataFrame:
    """J1 + J2: landed webhook payloads -> one row per (message, change) within the window.

    Wrong ``clientState`` is dropped (the documented validation); repeats of the same change of
    a message inside the watermark are dropped once-only with bounded state. A message that is
    created and then updated within the window gives both.
    """
    raw = spark.readStream.schema(NOTIFICATION_FILE).json(landing)
    rows = (raw.select("received_at", F.inline(F.from_json("payload", NOTIFICATION)["value"]))
            .filter(c("clientState") == client_state)
            .select(c("resourceData.id").alias("message_id"), "changeType", "received_at"))
    return (rows.withWatermark("received_at", dedupe_window)
            .dropDuplicatesWithinWatermark(["message_id", "changeType"]))


# --- J3 / J9: incremental pull with upsert -------------------------------------------

class KeyedUpsert:
    """foreachBatch sink with merge-on-read: newest ``order_col`` per key wins.

    Each micro-batch writes only its own rows (deduplicated per key) to
    ``source=<query id>/batch=<id>``; a batch re-delivered after a failure replaces itself and
    changes nothing. Batch ids start again after a bookmark is lost, but then the query has a new
    id and so a folder of its own: nothing is overwritten, and readers resolve the newest version
    per key. ``compact`` folds all folders into a base version that readers take instead.
    """

    def __init__(self, table_dir: str, keys: list[str], order_col: str):
        self.table_dir, self.keys, self.order_col = table_dir.rstrip("/"), keys, order_col

    def _newest(self, df: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
        order = F.struct(c(self.order_col), *[c(t) for t in ties]) if ties else c(self.order_col)
        vals = [x for x in df.columns if x not in self.keys and x not in ties]
        return df.groupBy(*self.keys).agg(F.max_by(F.struct(*vals), order).alias("_v")).select(*self.keys, "_v.*")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        source = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
        self._newest(batch).write.mode("overwrite").parquet(f"{self.table_dir}/source={source}/batch={batch_id:012d}")

    def _bases(self, spark: SparkSession) -> DataFrame | None:
        """Log of compactions: (at, base, source, batch) with a row for each folder folded."""
        try:
            return spark.read.parquet(f"{self.table_dir}/_log")
        except AnalysisException:  # never compacted
            return None

    def read_current(self, spark: SparkSession) -> DataFrame:
        """Current table: newest version per key over the base and the folders it lacks (late rows lose, J9)."""
        rows = spark.read.option("basePath", self.table_dir).parquet(self.table_dir) \
            .withColumns({"source": c("source").cast("string"), "batch": c("batch").cast("long")})
        log = self._bases(spark)
        if log is not None:
            last = log.orderBy(F.desc("at")).first()
            folded = log.filter(c("at") == last.at).select("source", "batch")
            rows = rows.join(folded, ["source", "batch"], "left_anti")
            base = spark.read.parquet(last.base).withColumns({"source": F.lit(""), "batch": F.lit(-1).cast("long")})
            rows = rows.unionByName(base.select(rows.columns))
        return self._newest(rows, ties=("batch", "source"))

    def compact(self, spark: SparkSession) -> str:
        """Fold the base and all folders into a new base (a separate maintenance job).

        The log entry is written after the data: readers see the old state or the new one.
        Folded folders can be removed once no reader of an older base is left.
        """
        at = time.time_ns()
        base = f"{self.table_dir}/_base/v-{at}"
        parts = spark.read.option("basePath", self.table_dir).parquet(self.table_dir).select(
            c("source").cast("string"), c("batch").cast("long")).distinct()
        parts = parts.withColumns({"at": F.lit(at), "base": F.lit(base)}).checkpoint()
        self.read_current(spark).write.mode("errorifexists").parquet(base)
        parts.write.mode("append").parquet(f"{self.table_dir}/_log")
        return base

    def watermark(self, spark: SparkSession):
        """Newest ``order_col`` of the table: where a pull without a bookmark can begin."""
        return self.read_current(spark).agg(F.max(self.order_col)).first()[0]


def incremental_pull(spark: SparkSession, landing: str, table_dir: str, name: str = "mail_delta",
                     since: object | None = None, overlap: str = "1 day"):
    """Process everything landed since the last run, then stop (bookmark = checkpoint).

    When a bookmark has expired (A16), call it under a new ``name`` with ``since`` = the table's
    ``watermark``: rows older than that, less ``overlap`` for late ones, are not pulled again, and
    those pulled twice resolve by key.
    """
    stream = spark.readStream.schema(MAIL_CHANGE).parquet(landing)
    if since is not None:
        stream = stream.filter(c("last_modified") >= F.lit(since) - F.expr(f"interval {overlap}"))
    return (stream.writeStream.foreachBatch(KeyedUpsert(table_dir, ["message_id"], "last_modified"))
            .option("checkpointLocation", _ckpt(spark, name)).trigger(availableNow=True).start())


# --- J4: gate ---------------------------------------------------------------------

def gate_batch(notes: DataFrame, decisions: DataFrame) -> DataFrame:
    """Already analysed -> sync only; otherwise -> classify (stream-static left join)."""
    seen = decisions.select("message_id").distinct().withColumn("_seen", F.lit(True))
    return notes.join(seen, "message_id", "left").select(
        "message_id", F.when(c("_seen"), "sync_only").otherwise("classify").alias("route"))


def gate_stream(spark: SparkSession, landing: str, decisions: DataFrame, sink, name: str = "gate") -> object:
    """J4 as a stream. ``name`` keys its checkpoint (offsets and the once-only state): a rerun
    under the same name resumes, and repeats already seen stay dropped."""
    notes = notification_stream(spark, landing)
    return (gate_batch(notes, decisions).writeStream.foreachBatch(sink)
            .option("checkpointLocation", _ckpt(spark, name)).trigger(availableNow=True).start())


def gate_live(notes: DataFrame, decisions: DataFrame, back: str = "30 days", late: str = "1 hour") -> DataFrame:
    """J4 with decisions as a stream, so that those made after the query's start count.

    ``notes``: (message_id, changeType, received_at) with its watermark; ``decisions``: (message_id,
    decided_at). A note is ``sync_only`` if a decision was made at most ``back`` before it, in
    whichever order the two arrive; ``classify`` once the watermark says that none will come any
    more. Each (message, change) is routed once, however many decisions and repeats there are.
    State is bounded: decisions for ``back`` and ``late``, notes until the watermark has passed them.
    """
    d = decisions.select(c("message_id").alias("_decided"), "decided_at").withWatermark("decided_at", late)
    met = F.expr(f"message_id = _decided and decided_at <= received_at and decided_at >= received_at - interval {back}")
    routed = notes.join(d, met, "left_outer").select(
        "message_id", "changeType", "received_at", F.when(c("_decided").isNotNull(), "sync_only").otherwise("classify").alias("route"))
    return routed.dropDuplicatesWithinWatermark(["message_id", "changeType"])


# --- J6 / J10: windowed aggregates --------------------------------------------------

def corrections_window_stream(spark: SparkSession, landing: str, days: int = 30, slide: str = "1 day",
                              late: str = "2 days") -> DataFrame:
    """Rolling 30-day corrections per domain, updated daily; late rows within ``late`` count."""
    fb = spark.readStream.schema(FEEDBACK).json(landing)
    return (fb.withWatermark("created_at", late)
            .groupBy(F.window("created_at", f"{days} days", slide), "from_domain")
            .agg(F.count(F.lit(1)).alias("corrections")))


def daily_digest_stream(decisions: DataFrame, late: str = "1 day") -> DataFrame:
    """Per-day, per-category decision counts (append mode after the watermark passes)."""
    return (decisions.withColumn("decided_at", c("decided_at").cast("timestamp")).withWatermark("decided_at", late)
            .groupBy(F.window("decided_at", "1 day"), "primary_category")
            .agg(F.count(F.lit(1)).alias("decisions"), F.avg("confidence").alias("avg_confidence")))
