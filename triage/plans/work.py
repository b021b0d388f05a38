"""Work selection and fetch bookkeeping.

``candidates`` is a page of the work queue (LIMIT/OFFSET is the feature: a claim of N items),
so the batch split over that page (a single ordered window) is bounded by the page size.
``batch_requests`` covers *all* eligible rows: it numbers items inside (user, salt) groups, so
a mailbox holding a third of all mail is spread over salts that follow its size, never one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triage import AS_OF
from triage.registry import register

c = F.col


def _as_of(ts: str = AS_OF):
    return F.lit(ts).cast("timestamp_ntz")


# --- K11 / K12 / K13 -----------------------------------------------------------

def queue_page(fx, limit: int = 500, offset: int = 0) -> DataFrame:
    """Unanalysed, live, not yet started mail; newest first; one page."""
    m = fx.mail.filter(c("analyzed_at").isNull() & ~F.coalesce(c("is_deleted"), F.lit(False))
                       & ~F.coalesce(c("auto_processed"), F.lit(False)))
    return m.orderBy(c("received_datetime").desc(), c("message_id")).offset(offset).limit(limit)


def candidate_page(fx, limit: int = 500, offset: int = 0) -> DataFrame:
    """One page of the queue with the presence and size of each body."""
    page = queue_page(fx, limit, offset)
    return page.join(body_facts(fx, page), "message_id", "left").select(
        "user_upn", "message_id", "subject", "from_domain", "from_address", "received_datetime", "needs_body",
        "analyzed_at", F.coalesce("has_body", F.lit(False)).alias("has_body"),
        F.when(c("is_there"), F.lit("html")).alias("body_content_type"),
        F.coalesce("body_size", F.lit(0)).cast("int").alias("body_size_bytes"))


def body_facts(fx, page: DataFrame, *more: Column) -> DataFrame:
    """Presence and length of the bodies of a page, taken at the scan: no body enters a shuffle.

    The page is bounded by its limit, so its ids are broadcast and the body table is filtered
    where it is read.
    """
    b = fx.body.join(F.broadcast(page.select("message_id").distinct()), "message_id", "left_semi")
    return b.select("message_id", c("content").isNotNull().alias("is_there"),
                    F.nullif(c("content"), F.lit("")).isNotNull().alias("has_body"),
                    F.length("content").alias("body_size"), *more)


SQL_PAGE = """page as (
  select * from mail where analyzed_at is null and coalesce(is_deleted, false) = false
    and coalesce(auto_processed, false) = false
  order by received_datetime desc, message_id limit 500 offset 0),
cand as (
  select p.user_upn, p.message_id, p.subject, p.from_domain, p.from_address, p.received_datetime, p.needs_body,
    p.analyzed_at, nullif(b.content, '') is not null as has_body,
    case when b.content is not null then 'html' end as body_content_type,
    cast(coalesce(length(b.content), 0) as int) as body_size_bytes
  from page p left join body b on b.message_id = p.message_id)"""


@register("candidates", ops="K11 B7 F6 C2 T27 T28", uses="mail body", sql="with " + SQL_PAGE + " select * from cand")
def candidates(fx, limit: int = 500, offset: int = 0) -> DataFrame:
    return candidate_page(fx, limit, offset)


def split_batches(page: DataFrame, n_batches: int, order: list) -> DataFrame:
    """E5: n items into k = min(N, n) batches of floor(n/k), the remainder going to the last."""
    w = Window.orderBy(*order)       # page-sized input: one ordered partition is fine
    n = F.count(F.lit(1)).over(Window.partitionBy())
    k = F.least(F.lit(n_batches), n)
    i = F.row_number().over(w) - 1
    return page.withColumn("batch_number", (F.least(F.floor(i / F.floor(n / k)), k - 1) + 1).cast("int"))


@register("work_batches", ops="K12 K13 E5", uses="mail body", sql="with " + SQL_PAGE + """,
numbered as (select message_id, user_upn, row_number() over (order by received_datetime desc, message_id) - 1 as i,
  count(*) over () as n from cand),
b as (select *, cast(least(i // (n // least(4, n)), least(4, n) - 1) + 1 as int) as batch_number from numbered)
select batch_number, count(*) as n_items, string_agg(message_id, ',' order by i) as message_ids
from b group by batch_number""")
def work_batches(fx, n_batches: int = 4, limit: int = 500, offset: int = 0) -> DataFrame:
    page = candidate_page(fx, limit, offset)
    b = split_batches(page, n_batches, [c("received_datetime").desc(), c("message_id")])
    w = Window.orderBy(c("received_datetime").desc(), c("message_id"))
    b = b.withColumn("_i", F.row_number().over(w))
    return b.groupBy("batch_number").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "message_id"))), lambda s: s["message_id"]),
                     ",").alias("message_ids"))


# --- K14 / J8: fetch outcome and retry schedule ------------------------------------

def fetch_outcome_df(fx, as_of: str = AS_OF) -> DataFrame:
    r = fx.response
    b = fx.body.select("message_id", (F.length("content") > 0).alias("has_content"))
    status = c("status_code")
    is_ok = (status >= 200) & (status < 300)
    retryable = (status == 429) | (status >= 500)
    # seconds, at least 1; a date counts from now; anything else is as if there were no header
    secs = F.regexp_extract(F.coalesce("retry_after", F.lit("")), r"^\s*(-?\d+)\s*$", 1).try_cast("long")
    until = F.try_to_timestamp(F.regexp_extract(F.coalesce("retry_after", F.lit("")), r"(\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2})", 1),
                               F.lit("d MMM yyyy HH:mm:ss"))
    left = F.unix_timestamp(until) - F.unix_timestamp(_as_of(as_of).cast("timestamp"))
    ra = F.coalesce(F.when(secs.isNotNull(), F.greatest(secs, F.lit(1))), F.when(left.isNotNull(), F.greatest(left, F.lit(1))))
    label = F.when(is_ok, "ok").when(retryable, F.concat(F.lit("retryable:"), status.cast("string"))) \
        .otherwise(F.concat(F.lit("fatal:"), status.cast("string")))
    has_content = F.coalesce(c("has_content"), F.lit(False))
    nxt = F.when(is_ok & has_content, "ok").when(is_ok, "empty").otherwise(label)
    retry_at = (F.when(is_ok & has_content, F.lit(None))
                .when(is_ok, _as_of(as_of) + F.make_dt_interval(hours=F.lit(2)))
                .when(retryable, _as_of(as_of) + F.make_dt_interval(secs=F.coalesce(ra, F.lit(120)).cast("decimal(18,6)"))))
    return r.join(b, "message_id", "left").select(
        "message_id", status.alias("status_code"), is_ok.alias("is_ok"), retryable.alias("is_retryable"),
        label.alias("status_label"), ra.cast("int").alias("retry_after_seconds"), nxt.alias("last_body_fetch_status"),
        retry_at.alias("retry_at"), (~(is_ok & has_content)).alias("needs_body"))


SQL_OUTCOME = """outcome as (
  select r.message_id, r.status_code, r.status_code >= 200 and r.status_code < 300 as is_ok,
    r.status_code = 429 or r.status_code >= 500 as is_retryable,
    case when r.status_code >= 200 and r.status_code < 300 then 'ok'
         when r.status_code = 429 or r.status_code >= 500 then 'retryable:' || cast(r.status_code as varchar)
         else 'fatal:' || cast(r.status_code as varchar) end as status_label,
    case when coalesce(r.retry_after, '') <> '' then greatest(cast(r.retry_after as int), 1) end as retry_after_seconds,
    coalesce(length(b.content) > 0, false) as has_content
  from response r left join body b on b.message_id = r.message_id),
fo as (
  select message_id, status_code, is_ok, is_retryable, status_label, retry_after_seconds,
    case when is_ok and has_content then 'ok' when is_ok then 'empty' else status_label end as last_body_fetch_status,
    case when is_ok and has_content then null
         when is_ok then timestamp '2024-01-31 00:00:00' + interval '2' hour
         when is_retryable then timestamp '2024-01-31 00:00:00' + to_seconds(coalesce(retry_after_seconds, 120))
    end as retry_at,
    not (is_ok and has_content) as needs_body
  from outcome)"""


@register("fetch_outcome", ops="K14 B14 B16 H(map lookup)", uses="response body", sql="with " + SQL_OUTCOME
          + " select * from fo")
def fetch_outcome(fx) -> DataFrame:
    return fetch_outcome_df(fx)


@register("retry_due", ops="J8 B11", uses="response body", sql="with " + SQL_OUTCOME + """
select message_id, last_body_fetch_status, retry_at from fo
where retry_at is not null and retry_at <= timestamp '2024-01-31 01:00:00'""")
def retry_due(fx, check_at: str = "2024-01-31 01:00:00") -> DataFrame:
    f = fetch_outcome_df(fx)
    return f.filter(c("retry_at").isNotNull() & (c("retry_at") <= _as_of(check_at))).select(
        "message_id", "last_body_fetch_status", "retry_at")


# --- K21: batch request rows ------------------------------------------------------

def salted(df: DataFrame, group: str, key: str, rows_per_salt: int = 1000) -> DataFrame:
    """``df`` with a ``salt`` from the key's md5 (reproducible outside Spark), as many per group as
    its size asks for: a group of any size falls into parts of about ``rows_per_salt`` rows."""
    sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / rows_per_salt).alias("_salts"))
    h = F.conv(F.substring(F.md5(c(key)), 1, 8), 16, 10).cast("bigint")
    return df.join(sizes, group).withColumn("salt", (h % c("_salts")).cast("int")).drop("_salts")


@register("batch_requests", ops="K21 E5", uses="mail desired_state", sql="""
with x as (
  select e.user_upn, e.message_id,
    cast(('0x' || substr(md5(e.message_id), 1, 8))::bigint
      % cast(ceil(count(*) over (partition by e.user_upn) / 1000.0) as bigint) as int) as salt
  from mail e join desired_state d on d.message_id = e.message_id
  where d.sync_status = 'synced' and d.synced_at < timestamp '2024-01-31 00:00:00' - interval '5' minute
    and e.is_deleted = false),
n as (select *, row_number() over (partition by user_upn, salt order by message_id) - 1 as i from x)
select user_upn, salt, cast(i // 20 as int) as request_batch, cast(i % 20 as varchar) as id, 'GET' as method,
  '/users/' || user_upn || '/messages/' || message_id || '?$select=id,categories,importance,flag,isRead' as url,
  message_id
from n""")
def batch_requests(fx, per_request: int = 20, rows_per_salt: int = 1000, as_of: str = AS_OF) -> DataFrame:
    """Rows {id, method, url} grouped into requests of at most ``per_request`` (DECISIONS: 20)."""
    d = fx.desired_state.filter((c("sync_status") == "synced")
                                & (c("synced_at") < _as_of(as_of) - F.make_dt_interval(mins=F.lit(5))))
    m = fx.mail.filter(c("is_deleted") == F.lit(False)).select("user_upn", "message_id")
    x = salted(m.join(d.select("message_id"), "message_id"), "user_upn", "message_id", rows_per_salt)
    i = F.row_number().over(Window.partitionBy("user_upn", "salt").orderBy("message_id")) - 1
    return x.withColumn("_i", i).select(
        "user_upn", "salt", (c("_i") / per_request).cast("int").alias("request_batch"),
        (c("_i") % per_request).cast("string").alias("id"), F.lit("GET").alias("method"),
        F.concat(F.lit("/users/"), c("user_upn"), F.lit("/messages/"), c("message_id"),
                 F.lit("?$select=id,categories,importance,flag,isRead")).alias("url"), "message_id")
