"""Two-way state sync.

The reference pairs service responses with database rows by list position (T20); here the
observed mailbox state is a table joined on ``message_id``. Every change row is processed,
not only the first (T22). All joins are equi-joins on the message key; the sender update is
two equi-joins (address key, domain key) instead of an OR join (K17).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triage import AS_OF
from triage.functions.features import match_address
from triage.operators.writes import upsert
from triage.plans.audit import sorted_or_empty
from triage.registry import register

c = F.col


def _ts(ts: str = AS_OF) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def polled(fx, as_of: str = AS_OF) -> DataFrame:
    """Synced decisions older than 5 minutes on live mail (T25: only 'synced' qualifies)."""
    d = fx.desired_state.filter((c("sync_status") == "synced")
                                & (c("synced_at") < _ts(as_of) - F.make_dt_interval(mins=F.lit(5))))
    m = fx.mail.filter(c("is_deleted") == F.lit(False)).select(
        "message_id", "user_upn", "from_address", "from_domain", "subject")
    return m.join(d.select("message_id", c("categories").alias("db_categories"), c("flag_status").alias("db_flag"),
                           c("importance").alias("db_importance"), "synced_at", "attention_tier"), "message_id")


def state_diff_df(fx, as_of: str = AS_OF) -> DataFrame:
    o = fx.observed_state.select("message_id", c("categories").alias("ol_categories"),
                                 c("flag_status").alias("ol_flag"), c("importance").alias("ol_importance"))
    j = polled(fx, as_of).join(o, "message_id")
    old_c, new_c = sorted_or_empty(c("db_categories")), sorted_or_empty(c("ol_categories"))
    old_f = F.coalesce(F.nullif(c("db_flag"), F.lit("")), F.lit("notFlagged"))
    new_f = F.coalesce(F.nullif(c("ol_flag"), F.lit("")), F.lit("notFlagged"))
    old_i = F.coalesce(F.nullif(c("db_importance"), F.lit("")), F.lit("normal"))
    new_i = F.coalesce(F.nullif(c("ol_importance"), F.lit("")), F.lit("normal"))
    return (j.select("message_id", "user_upn", "from_address", "from_domain", "subject", "attention_tier",
                     old_c.alias("old_categories"), new_c.alias("new_categories"), old_f.alias("old_flag"),
                     new_f.alias("new_flag"), old_i.alias("old_importance"), new_i.alias("new_importance"))
            .withColumn("categories_changed", c("old_categories") != c("new_categories"))
            .withColumn("flag_changed", c("old_flag") != c("new_flag"))
            .withColumn("importance_changed", c("old_importance") != c("new_importance"))
            .filter(c("categories_changed") | c("flag_changed") | c("importance_changed")))


def _sql_facts(table: str) -> str:
    return f"""select message_id, list_sort(coalesce(categories, []::varchar[])) as cats,
    if(coalesce(flag_status, '') = '', 'notFlagged', flag_status) as flag,
    if(coalesce(importance, '') = '', 'normal', importance) as imp from {table}"""


# oracle: both states in one form, then the messages whose forms differ
SQL_DIFF = f"""wanted as ({_sql_facts('desired_state')}
  where sync_status = 'synced' and synced_at + interval '5' minute < timestamp '2024-01-31 00:00:00'),
seen as ({_sql_facts('observed_state')}),
diff as (
  select m.message_id, m.user_upn, m.from_address, m.from_domain, m.subject, t.attention_tier,
    w.cats as old_categories, s.cats as new_categories, w.flag as old_flag, s.flag as new_flag,
    w.imp as old_importance, s.imp as new_importance, w.cats <> s.cats as categories_changed,
    w.flag <> s.flag as flag_changed, w.imp <> s.imp as importance_changed
  from mail m join wanted w using (message_id) join seen s using (message_id) join desired_state t using (message_id)
  where not m.is_deleted and row(w.cats, w.flag, w.imp) <> row(s.cats, s.flag, s.imp))"""


def _flat(df: DataFrame) -> DataFrame:
    return (df.withColumn("old_categories", F.array_join("old_categories", "|"))
            .withColumn("new_categories", F.array_join("new_categories", "|")))


SQL_FLAT = ("select * replace (array_to_string(old_categories, '|') as old_categories, "
            "array_to_string(new_categories, '|') as new_categories) from diff")


@register("state_diff", ops="K15 G3 B16 T20 T22 T25 C18", uses="mail desired_state observed_state",
          sql="with " + SQL_DIFF + "\n" + SQL_FLAT)
def state_diff(fx) -> DataFrame:
    return _flat(state_diff_df(fx))


# --- K16: feedback rows ---------------------------------------------------------

def feedback_from_diff(diff: DataFrame, as_of: str = AS_OF, derive_type: bool = False) -> DataFrame:
    ftype = (F.when(c("categories_changed"), "category_correction").when(c("flag_changed"), "flag_correction")
             .otherwise("importance_correction")) if derive_type else F.lit("category_correction")
    return diff.select("message_id", ftype.alias("feedback_type"), c("old_categories").alias("ai_categories"),
                       c("new_categories").alias("user_categories"), "from_address",
                       F.lower("from_domain").alias("from_domain"), _ts(as_of).alias("created_at"))


@register("feedback_rows", ops="K16 A8 T23", uses="mail desired_state observed_state", sql="with " + SQL_DIFF + """
select message_id, 'category_correction' as feedback_type, array_to_string(old_categories, '|') as ai_categories,
  array_to_string(new_categories, '|') as user_categories, from_address, lower(from_domain) as from_domain,
  timestamp '2024-01-31 00:00:00' as created_at from diff""")
def feedback_rows(fx) -> DataFrame:
    f = feedback_from_diff(state_diff_df(fx))
    return (f.withColumn("ai_categories", F.array_join("ai_categories", "|"))
            .withColumn("user_categories", F.array_join("user_categories", "|")))


# --- K17: sender learning --------------------------------------------------------

def learned_confidence(conf: Column, corrections_30d: Column, n: Column, threshold: int = 5) -> Column:
    """At ``threshold`` corrections in the window, greatest(conf - 5, 30) per correction;
    n sequential updates equal greatest(conf - 5n, 30), which also raises a value under 30 (T24)."""
    return F.when(corrections_30d >= threshold, F.greatest(conf - 5 * n, F.lit(30))).otherwise(conf)


def sender_learning_df(fx, as_of: str = AS_OF, window_days: int = 30, threshold: int = 5) -> DataFrame:
    """Corrections per sender key from one aggregate of the diff (address and domain keys as
    grouping sets), then two equi-joins to the sender table instead of an OR join."""
    diff = state_diff_df(fx, as_of)
    keys = diff.select(match_address(c("from_address")).alias("addr_key"), F.lower("from_domain").alias("dom_key"))
    per = keys.groupingSets([["addr_key"], ["dom_key"]], "addr_key", "dom_key").agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"))
    by_addr_n = per.filter(c("gid") == 1).select(c("addr_key").alias("sender_key"), "n")
    dom_n = per.filter(c("gid") == 2).select(c("dom_key").alias("from_domain"), "n")
    # the batch's own feedback rows count in their 30-day window (T23): n per domain at as_of
    recent = (fx.feedback.filter(c("created_at") > _ts(as_of) - F.make_dt_interval(F.lit(window_days)))
              .groupBy("from_domain").agg(F.count(F.lit(1)).alias("old"))
              .join(dom_n.withColumnRenamed("n", "new"), "from_domain", "full")
              .select("from_domain", (F.coalesce("old", F.lit(0)) + F.coalesce("new", F.lit(0))).alias("corrections_30d")))
    s = fx.sender
    by_addr = s.join(by_addr_n, "sender_key")
    by_dom = s.filter(c("sender_address").isNull()).join(dom_n.withColumnRenamed("from_domain", "sender_key"),
                                                          "sender_key")
    n = by_addr.unionByName(by_dom).groupBy("sender_key").agg(F.sum("n").alias("n"))
    upd = (s.join(n, "sender_key").join(recent.withColumnRenamed("from_domain", "sender_domain"), "sender_domain", "left")
           .withColumn("corrections_30d", F.coalesce("corrections_30d", F.lit(0))))
    conf = learned_confidence(c("confidence_score"), c("corrections_30d"), c("n"), threshold)
    return upd.select("sender_key", conf.cast("int").alias("confidence_score"),
                      (c("user_corrections") + c("n")).cast("int").alias("user_corrections"),
                      c("corrections_30d").cast("bigint").alias("corrections_30d"))


def _sql_match_addr(x):
    from triage.functions.features import sql_match_address
    return sql_match_address(x)


@register("sender_learning", ops="K17 J6 T22-T24 D1", uses="mail desired_state observed_state sender feedback",
          sql="with " + SQL_DIFF + f""",
fb as (select from_domain, created_at from feedback
       union all select lower(from_domain), timestamp '2024-01-31 00:00:00' from diff),
recent as (select from_domain, count(*) as corrections_30d from fb
           where created_at > timestamp '2024-01-31 00:00:00' - interval '30' day group by from_domain),
hits as (select {_sql_match_addr('from_address')} as addr_key, lower(from_domain) as dom_key from diff),
n as (select sender_key, sum(n) as n from (
        select s.sender_key, h.n from sender s join (select addr_key, count(*) as n from hits group by addr_key) h
          on h.addr_key = s.sender_key
        union all
        select s.sender_key, h.n from sender s join (select dom_key, count(*) as n from hits group by dom_key) h
          on h.dom_key = s.sender_key where s.sender_address is null) x group by sender_key)
select s.sender_key,
  cast(case when coalesce(r.corrections_30d, 0) >= 5 then greatest(s.confidence_score - 5 * n.n, 30)
       else s.confidence_score end as int) as confidence_score,
  cast(s.user_corrections + n.n as int) as user_corrections, cast(coalesce(r.corrections_30d, 0) as bigint) as corrections_30d
from sender s join n on n.sender_key = s.sender_key left join recent r on r.from_domain = s.sender_domain""")
def sender_learning(fx) -> DataFrame:
    return sender_learning_df(fx)


@register("corrections_30d", ops="J6 B11 D1 (batch twin)", uses="feedback", sql="""
select from_domain, count(*) as corrections, count(*) >= 5 as lowers_trust from feedback
where created_at > timestamp '2024-01-31 00:00:00' - interval '30' day group by from_domain""")
def corrections_30d(fx, as_of: str = AS_OF, days: int = 30) -> DataFrame:
    return (fx.feedback.filter(c("created_at") > _ts(as_of) - F.make_dt_interval(F.lit(days)))
            .groupBy("from_domain").agg(F.count(F.lit(1)).alias("corrections"))
            .withColumn("lowers_trust", c("corrections") >= 5))


# --- K18 / K28: accept observed state -------------------------------------------------

def accepted_state_df(fx, as_of: str = AS_OF, policy: str = "code") -> DataFrame:
    """New decision-store rows for changed messages (A7). ``policy='documented'`` marks them
    ``user_modified`` as the sync policy describes; the code resets ``synced`` (T26)."""
    diff = state_diff_df(fx, as_of)
    status = "synced" if policy == "code" else "user_modified"
    updates = diff.select(
        "message_id", c("new_categories").alias("categories"), c("new_flag").alias("flag_status"),
        c("new_importance").alias("importance"), F.lit(status).alias("sync_status"),
        F.to_json(F.struct(c("new_categories").alias("categories"), c("new_flag").alias("flag"),
                           c("new_importance").alias("importance"))).alias("state_snapshot"),
        _ts(as_of).alias("updated_at"))
    target = fx.desired_state.withColumn("state_snapshot", F.lit(None).cast("string")) \
        .withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    out = upsert(target, updates, ["message_id"],
                 ["categories", "flag_status", "importance", "sync_status", "state_snapshot", "updated_at"])
    return out.join(diff.select("message_id"), "message_id", "left_semi")


@register("accepted_state", ops="K18 A7 A4 T26", uses="mail desired_state observed_state", sql="with " + SQL_DIFF + """
select d.message_id, o.attention_tier, array_to_string(d.new_categories, '|') as categories, d.new_flag as flag_status,
  d.new_importance as importance, 'synced' as sync_status, o.synced_at, timestamp '2024-01-31 00:00:00' as updated_at
from diff d join desired_state o on o.message_id = d.message_id""")
def accepted_state(fx) -> DataFrame:
    return (accepted_state_df(fx).drop("state_snapshot")
            .withColumn("categories", F.array_join("categories", "|")))


@register("sync_log_rows", ops="K18 A8 A14", uses="mail desired_state observed_state")
def sync_log_rows(fx, as_of: str = AS_OF) -> DataFrame:
    """Append-only log rows of accepted user corrections (JSON columns; rows-only check)."""
    d = state_diff_df(fx, as_of)
    return d.select(
        "message_id", F.lit("mailbox_to_db").alias("sync_direction"), F.lit("user_correction").alias("sync_type"),
        F.lit("synced").alias("sync_status"),
        F.to_json(F.struct(c("new_categories").alias("categories"), c("new_flag").alias("flag"),
                           c("new_importance").alias("importance"))).alias("mailbox_state"),
        F.to_json(F.struct(c("old_categories").alias("categories"), c("old_flag").alias("flag"),
                           c("old_importance").alias("importance"))).alias("db_state"),
        F.to_json(F.struct(
            F.when(c("categories_changed"), F.struct(c("old_categories").alias("old"), c("new_categories").alias("new")))
            .alias("categories"),
            F.when(c("flag_changed"), F.struct(c("old_flag").alias("old"), c("new_flag").alias("new"))).alias("flag"),
            F.when(c("importance_changed"), F.struct(c("old_importance").alias("old"), c("new_importance").alias("new")))
            .alias("importance")), {"ignoreNullFields": "false"}).alias("changes_made"),
        _ts(as_of).alias("synced_at"))


@register("sync_policy", ops="K28 B14", uses="mail desired_state observed_state content", sql="with " + SQL_DIFF + """,
st as (select o.message_id, d.message_id is not null as changed, c.message_id is not null as analysed
       from observed_state o left join diff d on d.message_id = o.message_id
       left join (select distinct message_id from content) c on c.message_id = o.message_id)
select message_id, case when not analysed then 'new' when changed then 'user_modified' else 'system_change' end as policy
from st""")
def sync_policy(fx) -> DataFrame:
    """Documented policy: new mail -> full chain; user change -> DB only; else system change."""
    diff = state_diff_df(fx).select("message_id").withColumn("changed", F.lit(True))
    analysed = fx.content.select("message_id").distinct().withColumn("analysed", F.lit(True))
    j = fx.observed_state.select("message_id").join(diff, "message_id", "left").join(analysed, "message_id", "left")
    return j.select("message_id", F.when(~F.coalesce(c("analysed"), F.lit(False)), "new")
                    .when(F.coalesce(c("changed"), F.lit(False)), "user_modified").otherwise("system_change")
                    .alias("policy"))


# --- K19 / K20: push to the mailbox ----------------------------------------------------

DEFAULT_LABEL = "Passive Monitor"


def push_payload_df(fx, as_of: str = AS_OF) -> DataFrame:
    d = fx.desired_state
    m = fx.mail.filter(c("is_deleted") == F.lit(False)).select("message_id", "user_upn")
    cleaned = F.filter(F.transform(F.coalesce(c("categories"), F.array().cast("array<string>")), lambda x: F.trim(x)),
                       lambda x: x != "")
    cats = F.when(F.size(cleaned) > 0, cleaned).otherwise(F.array(F.lit(DEFAULT_LABEL)))   # T38: default after cleaning
    flag = F.coalesce(F.nullif(c("flag_status"), F.lit("")), F.lit("notFlagged"))
    now = _ts(as_of)
    enc = lambda x: F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))
    return m.join(d, "message_id").select(
        "message_id", "user_upn", F.coalesce("attention_tier", F.lit("B")).alias("attention_tier"),
        cats.alias("categories"), flag.alias("flag_status"),
        F.when(flag == "flagged", now).alias("flag_start"),
        F.when(flag == "flagged", now + F.make_dt_interval(hours=F.lit(24))).alias("flag_due"),
        F.when(flag == "complete", now).alias("flag_completed"),
        F.coalesce(F.nullif(c("importance"), F.lit("")), F.lit("normal")).alias("importance"),
        F.concat(F.lit("/users/"), enc(c("user_upn")), F.lit("/messages/"), enc(c("message_id"))).alias("graph_url"))


@register("push_payload", ops="K19 H(url encode, array map/filter) T38", uses="mail desired_state", sql=f"""
with x as (
  select e.message_id, e.user_upn, coalesce(d.attention_tier, 'B') as attention_tier,
    list_filter(list_transform(coalesce(d.categories, []::varchar[]), lambda s: trim(s)), lambda s: s <> '') as cl,
    coalesce(nullif(d.flag_status, ''), 'notFlagged') as flag_status,
    coalesce(nullif(d.importance, ''), 'normal') as importance
  from mail e join desired_state d on d.message_id = e.message_id where e.is_deleted = false)
select message_id, user_upn, attention_tier,
  array_to_string(case when len(cl) > 0 then cl else ['{DEFAULT_LABEL}'] end, '|') as categories, flag_status,
  case when flag_status = 'flagged' then timestamp '2024-01-31 00:00:00' end as flag_start,
  case when flag_status = 'flagged' then timestamp '2024-01-31 00:00:00' + interval '24' hour end as flag_due,
  case when flag_status = 'complete' then timestamp '2024-01-31 00:00:00' end as flag_completed,
  importance,
  '/users/' || replace(url_encode(user_upn), '+', '%20') || '/messages/' || replace(url_encode(message_id), '+', '%20')
    as graph_url
from x""")
def push_payload(fx) -> DataFrame:
    return push_payload_df(fx).withColumn("categories", F.array_join("categories", "|"))


@register("record_push", ops="K20 C4 A4 A8", uses="mail desired_state", sql=f"""
with p as (
  select d.message_id, coalesce(d.attention_tier, 'B') as attention_tier,
    list_filter(list_transform(coalesce(d.categories, []::varchar[]), lambda s: trim(s)), lambda s: s <> '') as cl,
    coalesce(nullif(d.flag_status, ''), 'notFlagged') as flag_status, coalesce(nullif(d.importance, ''), 'normal') as importance
  from desired_state d where (d.synced_at is null or d.sync_status is distinct from 'synced')
    and d.message_id in (select message_id from mail))
select message_id, attention_tier, array_to_string(case when len(cl) > 0 then cl else ['{DEFAULT_LABEL}'] end, '|')
  as categories, flag_status, importance, 'synced' as sync_status, timestamp '2024-01-31 00:00:00' as synced_at from p""")
def record_push(fx, as_of: str = AS_OF) -> DataFrame:
    """Decision rows after pushing every unsynced decision whose mail exists (semi-join, C4)."""
    d = fx.desired_state.filter(c("synced_at").isNull() | ~c("sync_status").eqNullSafe(F.lit("synced")))
    d = d.join(fx.mail.select("message_id"), "message_id", "left_semi")
    cleaned = F.filter(F.transform(F.coalesce(c("categories"), F.array().cast("array<string>")), lambda x: F.trim(x)),
                       lambda x: x != "")
    pushed = d.select(
        "message_id", F.coalesce("attention_tier", F.lit("B")).alias("attention_tier"),
        F.when(F.size(cleaned) > 0, cleaned).otherwise(F.array(F.lit(DEFAULT_LABEL))).alias("categories"),
        F.coalesce(F.nullif(c("flag_status"), F.lit("")), F.lit("notFlagged")).alias("flag_status"),
        F.coalesce(F.nullif(c("importance"), F.lit("")), F.lit("normal")).alias("importance"),
        F.lit("synced").alias("sync_status"), _ts(as_of).alias("synced_at"))
    new_state = upsert(fx.desired_state, pushed, ["message_id"])
    return (new_state.join(pushed.select("message_id"), "message_id", "left_semi")
            .select("message_id", "attention_tier", F.array_join("categories", "|").alias("categories"),
                    "flag_status", "importance", "sync_status", "synced_at"))
