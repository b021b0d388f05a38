"""Queries over written tables: co-located joins (C1, C2), reloads and logs read back (A5, A8, A15), sketches."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage import AS_OF
from triage.operators import writes
from triage.operators.colocated import bucket_count, write_bucketed
from triage.operators.sketches import daily_state, merged, rolling
from triage.plans import ingest, mining, sync
from triage.plans.audit import _mail_vs_desired, _mismatch
from triage.plans.reports import labelled
from triage.registry import register
from triage.sources.fixtures import Fixtures

c = F.col
KEY = "message_id"


class Colocated(Fixtures):
    """The mail tables in buckets of ``message_id``; every job that takes fixtures runs over them.

    A table is written when it is first read. Bucket counts follow from the row count of the mail.
    """

    def __init__(self, fx: Fixtures, buckets: int | None = None):
        super().__init__(fx.spark, fx.sf_dir)
        self.fx, self.buckets = fx, buckets or bucket_count(fx.mail.count())

    def stored(self, name: str) -> DataFrame:
        return write_bucketed(getattr(self.fx, name), KEY, self.buckets, name)

    mail = cached_property(lambda self: self.stored("mail"))
    decision = cached_property(lambda self: self.stored("decision"))
    content = cached_property(lambda self: self.stored("content"))
    header = cached_property(lambda self: self.stored("header"))
    desired_state = cached_property(lambda self: self.stored("desired_state"))
    observed_state = cached_property(lambda self: self.stored("observed_state"))


@register("mining_base_colocated", ops="C1 C2", uses="mail decision content header", sql="""
select d.primary_category, d.recommended_action, count(*) as mails, count(h.return_path) as with_return_path,
  count(k.business_relevance_score) as with_score, count(distinct m.from_domain) as domains
from decision d join mail m using (message_id) left join content k using (message_id) left join header h using (message_id)
where d.primary_category is not null and m.is_deleted is distinct from true group by all""")
def mining_base_colocated(fx) -> DataFrame:
    """The base of rule mining, joined bucket by bucket."""
    return mining.mining_base(Colocated(fx)).groupBy("primary_category", "recommended_action").agg(
        F.count(F.lit(1)).alias("mails"), F.count("return_path").alias("with_return_path"),
        F.count("business_relevance_score").alias("with_score"), F.count_distinct("from_domain").alias("domains"))


@register("state_diff_colocated", ops="C1 K15", uses="mail desired_state observed_state",
          sql="with " + sync.SQL_DIFF + "\n" + sync.SQL_FLAT)
def state_diff_colocated(fx) -> DataFrame:
    """``state_diff`` over co-located mail and states."""
    return sync.state_diff(Colocated(fx))


# --- writes that are read back -------------------------------------------------------

@register("folder_reload", ops="A5 A10", uses="folder", sql="with " + ingest.SQL_FLAT + " select * from flat")
def folder_reload(fx) -> DataFrame:
    """A5: the folder table is filled, then truncated and loaded anew; the rows are the table's."""
    table, flat = f"folders_{uuid.uuid4().hex}", ingest.folder_flatten(fx)
    writes.apply(flat.filter(c("level") == 0), table)
    writes.apply(flat, table)
    return writes.current(fx.spark, table)


@register("feedback_log", ops="A8 K16", uses="mail desired_state observed_state", sql="with " + sync.SQL_DIFF + f"""
select from_address, lower(from_domain) as from_domain, count(*) as corrections, timestamp '{AS_OF}' as last_at
from diff group by all""")
def feedback_log(fx) -> DataFrame:
    """Feedback appended to a log in two batches, and the corrections that the log holds by sender."""
    table, rows = f"feedback_{uuid.uuid4().hex}", sync.feedback_rows(fx)
    late = F.pmod(F.xxhash64(KEY), F.lit(2)) == 1
    writes.apply(rows.limit(0), table)
    for batch in (rows.filter(~late), rows.filter(late)):
        writes.apply(batch, table, mode="append")
    return writes.current(fx.spark, table).groupBy("from_address", "from_domain").agg(
        F.count(F.lit(1)).alias("corrections"), F.max("created_at").alias("last_at"))


@register("correction_apply", ops="A15 A7 I19", uses="mail desired_state", sql="""
with j as (select e.message_id, e.flag_status as f0, d.flag_status as f1, e.categories as c0, d.categories as c1,
    d.message_id is not null and (e.flag_status is distinct from d.flag_status
      or list_sort(coalesce(e.categories, []::varchar[])) is distinct from list_sort(coalesce(d.categories, []::varchar[]))) as fix
  from mail e left join desired_state d on d.message_id = e.message_id)
select message_id, case when fix then f1 else f0 end as flag_status,
  array_to_string(case when fix then c1 else c0 end, '|') as categories from j""")
def correction_apply(fx) -> DataFrame:
    """The previewed corrections applied to the mail table; without ``apply`` nothing is written."""
    flag, cats = _mismatch()
    fixes = _mail_vs_desired(fx).filter(flag | cats).select(KEY, c("dec_flag").alias("flag"), c("dec_cats").alias("cats"))
    new = writes.update_from(fx.mail.select(KEY, "flag_status", "categories"), fixes, [KEY],
                             {"flag_status": c("src_flag"), "categories": c("src_cats")})
    table = f"mail_{uuid.uuid4().hex}"
    writes.apply(new, table)
    return writes.current(fx.spark, table).withColumn("categories", F.array_join("categories", "|"))


# --- distinct counts that merge ------------------------------------------------------

REACH = ["primary_category"]


def reach_state(lab: DataFrame) -> DataFrame:
    return daily_state(lab, REACH, F.to_date("decided_at"), {"senders": F.lower("from_address"), "domains": F.lower("from_domain")})


@register("reach_7d", ops="D2 I10")
def reach_7d(fx) -> DataFrame:
    """Decisions, senders and domains (estimates) of each category in the seven days up to each day, from daily
    sketches that two batches of decisions filled."""
    lab = labelled(fx)
    late = F.pmod(F.xxhash64(KEY), F.lit(2)) == 1
    state = merged(reach_state(lab.filter(~late)), reach_state(lab.filter(late)), REACH)
    return rolling(state, REACH, 7).withColumnRenamed("n", "decisions")
