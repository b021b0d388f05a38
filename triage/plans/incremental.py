"""Incremental rule mining with retractions (K3 kept up to date by the changes of A4, A7 and K18).

The mined table is a sum, so it is kept as one and changed by signed rows instead of being mined
anew from all mail: an insert adds a base row, a delete retracts it, a correction does both. State:

* ``cells``: (feature, key, category, action, day of the decision) -> count, relevance sum, first and
  last decision. Counts and sums follow from signs. First and last don't: where a retraction takes
  away a cell's extreme, that cell alone is derived again, from the history rows of its day.
* ``subjects``: (feature, key, subject) -> count, so that a subject leaves with its last mail.
* ``total``: the number of base rows.

A batch costs its own rows, one merge of the state on its keys (partial aggregates below each
shuffle, so a hot key arrives reduced) and the touched days of the history. Any order of batches
that never retracts a row before its insert gives the state of mining the end result at once;
retracting what isn't there is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.functions.features import FEATURES, mining_features, mining_return_path_clean
from triage.operators.aggregates import sample_joined
from triage.operators.writes import apply
from triage.plans.mining import MINING_CTES, SAMPLE_SUBJECTS, SUBJECT_WIDTH, metrics_of, mining_base
from triage.registry import register
from triage.session import checkpoint_dir

c = F.col

KEYS = ["feature", "key_value"]
CELL = [*KEYS, "primary_category", "action", "day"]
CELL_SCHEMA = ("feature string, key_value string, primary_category string, action string, day date, cnt bigint, "
               "rel_sum decimal(28,4), first_seen timestamp_ntz, last_seen timestamp_ntz")
SUBJECT_SCHEMA = "feature string, key_value string, subject string, cnt bigint"
ROW = ["subject", "primary_category", "action", "relevance", "decided_at", "day"]


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def base_rows(base: DataFrame) -> DataFrame:
    """Base rows of mining with their ten features as columns; any other columns are kept."""
    staged = base.withColumn("_rp", mining_return_path_clean(c("return_path")))
    extra = [x for x in ("batch", "sign", "is_deleted", "message_id") if x in base.columns]
    return staged.select(
        *extra, F.substring("subject", 1, SUBJECT_WIDTH).alias("subject"), "primary_category",
        F.coalesce("recommended_action", F.lit("")).alias("action"), "relevance", "decided_at",
        F.to_date("decided_at").alias("day"), *mining_features("_rp"))


def signed_features(rows: DataFrame) -> DataFrame:
    """(sign, row, feature, key_value) of signed base rows, empty keys dropped."""
    return rows.select("sign", *ROW, *FEATURES).unpivot(["sign", *ROW], list(FEATURES), "feature", "key_value").filter(
        c("key_value").isNotNull() & (c("key_value") != ""))


def _counted(n):
    return F.when(n >= 0, n).otherwise(F.raise_error(F.lit("a retracted row was never inserted")).cast("bigint"))


@dataclass(frozen=True)
class MiningState:
    cells: DataFrame
    subjects: DataFrame
    total: DataFrame  # one row, n

    @staticmethod
    def empty(spark: SparkSession) -> MiningState:
        return MiningState(spark.createDataFrame([], CELL_SCHEMA), spark.createDataFrame([], SUBJECT_SCHEMA),
                           spark.createDataFrame([(0,)], "n bigint"))

    def metrics(self) -> DataFrame:
        """The rows of ``rule_mining`` over the base rows that the state stands for."""
        per = self.cells.groupBy(*KEYS, "primary_category", "action").agg(
            F.sum("cnt").alias("cnt"), F.sum("rel_sum").alias("rel_sum"), F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"))
        samples = sample_joined(self.subjects, KEYS, "subject", SAMPLE_SUBJECTS, " | ", "sample_subjects")
        return metrics_of(per, self.total).join(samples, KEYS, "left")

    def save(self) -> dict[str, str]:
        """Written as new versions under the shared folder; ``load`` takes the paths."""
        return {"cells": apply(self.cells, "mining_cells"), "subjects": apply(self.subjects, "mining_subjects"),
                "total": apply(self.total, "mining_total")}

    @staticmethod
    def load(spark: SparkSession, paths: dict[str, str]) -> MiningState:
        return MiningState(*(spark.read.parquet(paths[x]) for x in ("cells", "subjects", "total")))

    def changed(self, delta: DataFrame, history: DataFrame) -> MiningState:
        """The state after a batch. ``delta``: its signed ``base_rows``; ``history``: all signed rows up
        to and with the batch, read for the days in which a cell lost its first or last decision."""
        rows = signed_features(delta)
        came, went = F.when(c("sign") > 0, c("decided_at")), F.when(c("sign") < 0, c("decided_at"))
        change = rows.groupBy(*CELL).agg(
            F.sum("sign").cast("bigint").alias("cnt"), F.sum(c("sign") * c("relevance")).cast("decimal(28,4)").alias("rel_sum"),
            F.min(came).alias("first_seen"), F.max(came).alias("last_seen"), F.min(went).alias("went_first"), F.max(went).alias("went_last"))
        none = F.lit(None).cast("timestamp_ntz")
        cells = (self.cells.withColumns({"went_first": none, "went_last": none}).unionByName(change).groupBy(*CELL).agg(
            _counted(F.sum("cnt")).alias("cnt"), F.sum("rel_sum").cast("decimal(28,4)").alias("rel_sum"),
            *[f(x).alias(x) for f, x in ((F.min, "first_seen"), (F.max, "last_seen"), (F.min, "went_first"), (F.max, "went_last"))])
            .filter("cnt > 0"))
        cells = _cut(cells.withColumn("lost", F.expr("coalesce(went_first <= first_seen or went_last >= last_seen, false)"))
                     .drop("went_first", "went_last"))
        lost = cells.filter("lost").select(*CELL)
        if lost.isEmpty():
            cells = cells.drop("lost")
        else:
            cells = _cut(cells.drop("lost").join(_extremes(history, lost), CELL, "left").withColumns(
                {x: F.coalesce(f"_{x}", x) for x in ("first_seen", "last_seen")}).drop("_first_seen", "_last_seen"))
        subjects = rows.filter("subject is not null").groupBy(*KEYS, "subject").agg(F.sum("sign").cast("bigint").alias("cnt"))
        subjects = _cut(self.subjects.unionByName(subjects).groupBy(*KEYS, "subject").agg(
            _counted(F.sum("cnt")).alias("cnt")).filter("cnt > 0"))
        total = _cut(self.total.unionByName(delta.agg(F.coalesce(F.sum("sign"), F.lit(0)).cast("bigint").alias("n"))).agg(F.sum("n").alias("n")))
        return MiningState(cells, subjects, total)


def _extremes(history: DataFrame, cells: DataFrame) -> DataFrame:
    """First and last decision of the given cells: history rows of their days, netted by time."""
    days = history.join(cells.select("day").distinct(), "day", "left_semi")
    left = (signed_features(days).join(cells, CELL, "left_semi").groupBy(*CELL, "decided_at").agg(F.sum("sign").alias("n"))
            .filter("n > 0"))
    return left.groupBy(*CELL).agg(F.min("decided_at").alias("_first_seen"), F.max("decided_at").alias("_last_seen"))


# --- the registered query: four batches that end in the given tables ----------------------------

def change_log(fx) -> DataFrame:
    """Signed base rows in four batches, by a hash of the message: most come first and stay, some come
    later, some are corrected (category and time), some leave and return; deleted mail leaves last."""
    base = mining_base(fx, deleted=True)
    kind = F.crc32(c("message_id").cast("binary")) % 10

    def change(batch, sign, before=False):
        cat = F.lit("uncategorized") if before else c("primary_category")
        at = c("decided_at") - F.make_dt_interval(hours=F.lit(40)) if before else c("decided_at")
        return F.struct(F.lit(batch).alias("batch"), F.lit(sign).alias("sign"), cat.alias("primary_category"), at.alias("decided_at"))

    steps = (F.when(kind == 0, F.array(change(1, 1)))
             .when(kind == 1, F.array(change(0, 1, True), change(2, -1, True), change(2, 1)))
             .when(kind == 2, F.array(change(1, 1), change(2, -1), change(3, 1))).otherwise(F.array(change(0, 1))))
    gone = F.when(c("is_deleted").eqNullSafe(F.lit(True)), F.array(change(3, -1)))
    steps = F.concat(steps, F.coalesce(gone, F.filter(steps, lambda x: F.lit(False))))
    rest = [x for x in base.columns if x not in ("primary_category", "decided_at")]
    return base_rows(base.select(*rest, F.explode(steps).alias("_s")).select(*rest, "_s.*"))


@register("rule_mining_incremental", ops="K3 A4 A7 K18 D1 D13 D14", uses="mail decision content header",
          sql=MINING_CTES + "\nselect * from metrics")
def rule_mining_incremental(fx) -> DataFrame:
    """Rule mining kept up to date over four batches of inserts, corrections and deletes; the end
    state's metrics are those of mining the end state at once."""
    log = _cut(change_log(fx))
    state = MiningState.empty(fx.spark)
    for batch in range(4):
        state = state.changed(log.filter(c("batch") == batch), log.filter(c("batch") <= batch))
    return state.metrics()
