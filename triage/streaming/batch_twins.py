"""Batch twins of the streaming jobs (J3, J4, J5, J9, J10), registered with SQL oracles.

Each twin computes, over the whole table at once, what the stream computes batch by batch;
tests check that both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.functions.numeric import avg_round, sql_avg_round
from triage.plans.ingest import notification_rows
from triage.operators.writes import update_from
from triage.plans.work import body_facts, queue_page
from triage.registry import register
from triage.streaming.jobs import gate_batch

c = F.col


def mail_changes(events: DataFrame) -> DataFrame:
    """Change records for mail: three versions per message, arriving out of order."""
    eid = c("event_id")
    return events.select(
        F.concat(F.lit("msg-"), (eid - eid % 3).cast("string")).alias("message_id"),
        F.concat(F.lit("box"), (c("user_id") % 5).cast("string"), F.lit("@home.test")).alias("user_upn"),
        F.concat(c("event_type"), F.lit(" v"), (eid % 3).cast("string")).alias("subject"),
        F.concat(F.lit("U"), c("user_id").cast("string"), F.lit("@d.example.com")).alias("from_address"),
        c("ts").alias("last_modified"))


@register("delta_merge", ops="J3 J9 A4 (batch twin) A16", uses="", sql="""
select message_id, arg_max(user_upn, last_modified) as user_upn, arg_max(subject, last_modified) as subject,
  arg_max(from_address, last_modified) as from_address, max(last_modified) as last_modified
from (select 'msg-' || cast(event_id - event_id % 3 as varchar) as message_id,
        'box' || cast(user_id % 5 as varchar) || '@home.test' as user_upn,
        event_type || ' v' || cast(event_id % 3 as varchar) as subject,
        'U' || cast(user_id as varchar) || '@d.example.com' as from_address, ts as last_modified from events) x
group by message_id""")
def delta_merge(fx) -> DataFrame:
    """Newest version per message wins; an older (late) version never overwrites."""
    ch = mail_changes(fx.events)
    return ch.groupBy("message_id").agg(
        F.max_by(F.struct("user_upn", "subject", "from_address", "last_modified"), "last_modified").alias("v")
    ).select("message_id", "v.*")


@register("gate_routing", ops="J4 C2 (batch twin)", uses="notification decision", sql="""
with n as (select distinct v.resourceData.id as message_id
  from notification, unnest(from_json(payload, '{"value":[{"changeType":"VARCHAR","clientState":"VARCHAR",
    "resourceData":{"id":"VARCHAR"}}]}').value) as t(v) where v.clientState = 'ok')
select n.message_id, case when exists (select 1 from decision d where d.message_id = n.message_id)
  then 'sync_only' else 'classify' end as route from n""")
def gate_routing(fx) -> DataFrame:
    notes = notification_rows(fx.notification).select("message_id").distinct()
    return gate_batch(notes, fx.decision)


SQL_CLAIM = """with page as (
  select * from mail where analyzed_at is null and coalesce(is_deleted, false) = false
    and coalesce(auto_processed, false) = false
  order by received_datetime desc, message_id limit 500)"""


@register("claim_once", ops="J5 A6 K11 (batch twin)", uses="mail body", sql=SQL_CLAIM + """
select p.message_id, p.subject, p.from_domain, p.from_address, b.content is not null as has_content, b.content,
  p.received_datetime, true as auto_processed, 'signal' as analysis_level, 'v1' as model_version,
  'ca-1' as analyzer_version
from page p left join body b on b.message_id = p.message_id""")
def claim_once(fx, limit: int = 500, offset: int = 0) -> DataFrame:
    """Rows claimed by a run (the UPDATE .. RETURNING of the work queue), with their new state.

    The claimed set is a pure function of the queue state, so re-running the same batch
    returns the same rows and flips nothing twice (idempotent by batch). Bodies are filtered at
    their scan by the page's ids; ``claimed_state`` is the table after the claim.
    """
    page = queue_page(fx, limit, offset)
    return page.join(body_facts(fx, page, c("content")), "message_id", "left").select(
        "message_id", "subject", "from_domain", "from_address", F.coalesce("is_there", F.lit(False)).alias("has_content"),
        "content", "received_datetime", F.lit(True).alias("auto_processed"), F.lit("signal").alias("analysis_level"),
        F.lit("v1").alias("model_version"), F.lit("ca-1").alias("analyzer_version"))


@register("claimed_state", ops="A6 A7 J5", uses="mail", sql=SQL_CLAIM + """
select m.message_id, coalesce(m.auto_processed, false) or m.message_id in (select message_id from page) as auto_processed
from mail m""")
def claimed_state(fx, limit: int = 500, offset: int = 0) -> DataFrame:
    """The queue after a claim: UPDATE mail SET auto_processed FROM the claimed page."""
    mail = fx.mail.select("message_id", F.coalesce("auto_processed", F.lit(False)).alias("auto_processed"))
    page = queue_page(fx, limit, offset).select("message_id", F.lit(True).alias("auto_processed"))
    return update_from(mail, F.broadcast(page), ["message_id"], {"auto_processed": c("src_auto_processed")})


@register("daily_digest", ops="J10 D1 D10 (batch twin)", uses="decision", sql=f"""
select cast(decided_at as date) as day, primary_category, count(*) as decisions,
  {sql_avg_round('confidence')} as avg_confidence from decision group by 1, 2""")
def daily_digest(fx) -> DataFrame:
    return fx.decision.groupBy(F.to_date("decided_at").alias("day"), "primary_category").agg(
        F.count(F.lit(1)).alias("decisions"), avg_round(c("confidence")).alias("avg_confidence"))
