"""Gateway: curated lists first, then mined rules, else unmatched (K8, C13-C15, C19, T11-T16),
plus coverage (I34), composite seed rules (B13, K26) and folder routing (K30).

Plan: match features are computed once per mail and exploded to non-empty (feature, value) rows,
which meet one matcher table (equality lists, vip_personal, rules) by an inner equi-join, and the
fragment list by an equi-join on substrings. Only hits reach the aggregate on ``message_id``, which
picks the winners with ``min_by`` over a total order (C15); a final projection applies the
precedence lists > finance special case > rules > unmatched (C19). Which side is broadcast is left
to adaptive execution.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triage.functions.features import select_match_features, sql_match_features
from triage.functions.numeric import ratio, sql_ratio
from triage.operators.joins import contains_join
from triage.registry import register

c = F.col

# fixed values: generic local-part prefixes of the finance special case
GENERIC_PREFIXES = ("noreply", "no-reply", "alerts", "newsletter", "info", "support", "notifications", "news",
                    "updates", "marketing")
EQ_LIST_TYPES = ("from_address", "from_domain", "message_id_domain", "list_domain", "unsub_domain")
RULE_FEATURES = ("from_address", "sender_address", "reply_to_address", "from_domain", "message_id_domain",
                 "list_domain", "unsub_domain", "precedence", "auto_submitted")


def priority_score(priority: Column, precision: Column, relevance: Column | None = None) -> Column:
    """10 -> 80, 20 -> 60, anything else 40; +10 at precision >= 95, +5 at >= 90; +5 at relevance >= 80."""
    base = F.when(priority == 10, 80).when(priority == 20, 60).otherwise(40)
    bonus = F.when(precision >= 95, 10).when(precision >= 90, 5).otherwise(0)
    rel = F.lit(0) if relevance is None else F.when(relevance >= 80, 5).otherwise(0)
    return F.least(base + F.coalesce(bonus, F.lit(0)) + F.coalesce(rel, F.lit(0)), F.lit(100))


def mail_features(mail: DataFrame) -> DataFrame:
    return select_match_features(mail)


def matchers(lists: DataFrame, rules: DataFrame) -> DataFrame:
    """One lookup table keyed by (feature, value): equality lists, vip_personal, active rules."""
    active = lists.filter(c("is_active") == F.lit(True))
    none_s, none_i = F.lit(None).cast("string"), F.lit(None).cast("int")
    eq = active.filter(c("identifier_type").isin(list(EQ_LIST_TYPES))).select(
        c("identifier_type").alias("feature"), c("identifier_value").alias("value"), F.lit("list").alias("kind"),
        "list_type", "identifier_type", "identifier_value", "target_category", "recommended_action", "priority",
        none_s.alias("version"), none_i.alias("precision_cat_pct"), none_i.alias("support"))
    # A vip_personal entry matches the normalised sender whatever its identifier type
    vip = active.filter(c("list_type") == "vip_personal").select(
        F.lit("from_address").alias("feature"), c("identifier_value").alias("value"), F.lit("vip").alias("kind"),
        *[none_s.alias(x) for x in ("list_type", "identifier_type", "identifier_value", "target_category",
                                    "recommended_action")], none_i.alias("priority"), none_s.alias("version"),
        none_i.alias("precision_cat_pct"), none_i.alias("support"))
    rl = rules.filter(c("is_active") == F.lit(True)).select(
        "feature", c("key_value").alias("value"), F.lit("rule").alias("kind"), none_s.alias("list_type"),
        c("feature").alias("identifier_type"), c("key_value").alias("identifier_value"), "target_category",
        "recommended_action", "priority", "version", "precision_cat_pct", "support")
    return eq.unionByName(vip).unionByName(rl)


def gateway_hits(mail: DataFrame, lists: DataFrame, rules: DataFrame) -> DataFrame:
    """Per message: best list hit, best rule hit, vip flag, normalised sender.

    Features become (feature, value) rows, without the empty ones; an inner equi-join with the
    matcher table and the substring equi-join with the fragments leave hits only. One aggregate
    per message picks the winners, and messages without a hit come back by a left join that
    carries two narrow columns.
    """
    feats = mail_features(mail)
    kv = feats.select("message_id", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), c(f).alias("value")) for f in RULE_FEATURES])).alias("kv")
    ).select("message_id", c("kv.feature").alias("feature"), c("kv.value").alias("value")).filter("value <> ''")
    cols = ["message_id", "kind", "list_type", "identifier_type", "identifier_value", "target_category",
            "recommended_action", "priority", "version", "precision_cat_pct", "support"]
    hits = kv.join(matchers(lists, rules), ["feature", "value"]).select(cols)
    frag = lists.filter((c("is_active") == F.lit(True)) & (c("identifier_type") == "from_address_contains")).select(
        "identifier_value", F.lit("list").alias("kind"), "list_type", "identifier_type", "target_category",
        "recommended_action", "priority", F.lit(None).cast("string").alias("version"),
        F.lit(None).cast("int").alias("precision_cat_pct"), F.lit(None).cast("int").alias("support"))
    inside = contains_join(feats.select("message_id", "from_address"), "from_address", frag, "identifier_value")
    hits = hits.unionByName(inside.select(cols))

    def best(kind, values, order):
        return F.min_by(F.when(c("kind") == kind, F.struct(*values)), F.when(c("kind") == kind, F.struct(*order)))

    agg = hits.groupBy("message_id").agg(
        best("list", ["list_type", "identifier_type", "identifier_value", "target_category", "recommended_action",
                      "priority"], ["priority", "list_type", "identifier_value", "identifier_type"]).alias("l"),
        best("rule", ["version", "identifier_type", "identifier_value", "target_category", "recommended_action",
                      "priority", "precision_cat_pct", "support"],
             ["priority", "identifier_type", "identifier_value", "version"]).alias("r"),
        F.bool_or(c("kind") == "vip").alias("is_vip_personal"))
    return feats.select("message_id", "from_address").join(agg, "message_id", "left")


def gateway(mail: DataFrame, lists: DataFrame, rules: DataFrame) -> DataFrame:
    j = gateway_hits(mail, lists, rules).select(
        "message_id", "from_address", *[c("l." + x).alias("l_" + x) for x in
                                       ("list_type", "identifier_type", "identifier_value", "target_category",
                                        "recommended_action", "priority")],
        c("r.identifier_type").alias("r_feature"), c("r.identifier_value").alias("r_key_value"),
        *[c("r." + x).alias("r_" + x) for x in ("version", "target_category", "recommended_action", "priority",
                                                "precision_cat_pct", "support")],
        "is_vip_personal")

    local = F.coalesce(F.split_part(c("from_address"), F.lit("@"), F.lit(1)), F.lit(""))
    generic = F.lit(False)
    for p in GENERIC_PREFIXES:
        generic = generic | local.startswith(p)
    has_list, has_rule = c("l_list_type").isNotNull(), c("r_feature").isNotNull()
    finance_person = has_list & (c("l_list_type") == "vip_finance") & ~generic & (F.instr(local, ".") > 0)
    vip_hit = finance_person & F.coalesce(c("is_vip_personal"), F.lit(False))
    list_ok = has_list & ~finance_person

    def pick(vip_v, list_v, rule_v, none_v=None):
        none = F.lit(none_v) if not isinstance(none_v, Column) else none_v
        return (F.when(vip_hit, vip_v).when(finance_person, none).when(list_ok, list_v)
                .when(has_rule, rule_v).otherwise(none))

    rule_prec = c("r_precision_cat_pct")
    return j.select(
        "message_id",
        pick(F.lit(True), F.lit(True), F.lit(True), False).alias("matched"),
        pick(F.lit("contact_lists_vip_personal"), F.concat(F.lit("contact_lists_"), c("l_list_type")),
             F.lit("classification_rules"), "needs_ai").alias("classification_source"),
        pick(F.lit("business_critical"), c("l_target_category"), c("r_target_category")).alias("primary_category"),
        pick(F.lit("review"), c("l_recommended_action"),
             F.coalesce(F.nullif(c("r_recommended_action"), F.lit("")), F.lit("review"))).alias("recommended_action"),
        pick(F.lit(95), F.lit(95), F.coalesce(F.nullif(rule_prec, F.lit(0)), F.lit(90))).cast("int").alias("confidence"),
        pick(F.lit(90), priority_score(c("l_priority"), F.lit(95), F.lit(90)),
             priority_score(c("r_priority"), rule_prec)).cast("int").alias("priority_score"),
        pick(F.lit("vip_personal"), c("l_list_type"), F.lit(None).cast("string")).alias("list_type"),
        pick(F.lit(None).cast("string"), c("l_identifier_value"), c("r_key_value")).alias("matched_value"),
        pick(F.lit(None).cast("string"), F.lit(None).cast("string"), c("r_feature")).alias("rule_feature"),
        F.when(finance_person & ~vip_hit, F.lit("vip finance domain but personal sender"))
        .when(~list_ok & ~vip_hit & ~has_rule, F.lit("no matching rules or contacts")).alias("reason"),
    )


def _sql_gateway() -> str:
    mf = sql_match_features()
    feats = ", ".join(f"{v} as {k}" for k, v in mf.items())
    eq_union = " union all ".join(
        f"select message_id, '{t}' as identifier_type, {t} as value from feats where {t} is not null"
        for t in EQ_LIST_TYPES)
    rule_union = " union all ".join(
        f"select message_id, '{t}' as feature, {t} as value from feats where {t} is not null and {t} <> ''"
        for t in RULE_FEATURES)
    generic = " or ".join(f"starts_with(localpart, '{p}')" for p in GENERIC_PREFIXES)
    return f"""with feats as (select message_id, {feats} from mail),
lists as (select * from list_entry where is_active = true),
lhits as (
  select l.message_id, e.list_type, e.identifier_type, e.identifier_value, e.target_category, e.recommended_action,
    e.priority
  from ({eq_union}) l join lists e on e.identifier_type = l.identifier_type and e.identifier_value = l.value
  union all
  select f.message_id, e.list_type, e.identifier_type, e.identifier_value, e.target_category, e.recommended_action,
    e.priority
  from feats f join lists e on e.identifier_type = 'from_address_contains' and length(e.identifier_value) > 0
    and position(e.identifier_value in f.from_address) > 0),
bl as (select * from (select *, row_number() over (partition by message_id
         order by priority, list_type, identifier_value, identifier_type) as rn from lhits) x where rn = 1),
rhits as (select h.message_id, r.* from ({rule_union}) h
          join (select * from rule where is_active = true) r on r.feature = h.feature and r.key_value = h.value),
br as (select * from (select *, row_number() over (partition by message_id
         order by priority, feature, key_value, version) as rn from rhits) x where rn = 1),
vip as (select distinct identifier_value from lists where list_type = 'vip_personal'),
j as (
  select f.message_id, coalesce(split_part(f.from_address, '@', 1), '') as localpart,
    bl.list_type as l_list_type, bl.identifier_value as l_identifier_value, bl.target_category as l_target_category,
    bl.recommended_action as l_recommended_action, bl.priority as l_priority,
    br.feature as r_feature, br.key_value as r_key_value, br.target_category as r_target_category,
    br.recommended_action as r_recommended_action, br.priority as r_priority, br.precision_cat_pct as r_prec,
    vip.identifier_value is not null as is_vip
  from feats f left join bl on bl.message_id = f.message_id left join br on br.message_id = f.message_id
  left join vip on vip.identifier_value = f.from_address),
k as (
  select *, l_list_type is not null and l_list_type = 'vip_finance' and not ({generic})
      and position('.' in localpart) > 0 as finance_person from j),
m as (select *, finance_person and is_vip as vip_hit,
        l_list_type is not null and not finance_person as list_ok, r_feature is not null as has_rule from k)
select message_id,
  case when vip_hit then true when finance_person then false when list_ok then true when has_rule then true
       else false end as matched,
  case when vip_hit then 'contact_lists_vip_personal' when finance_person then 'needs_ai'
       when list_ok then 'contact_lists_' || l_list_type when has_rule then 'classification_rules'
       else 'needs_ai' end as classification_source,
  case when vip_hit then 'business_critical' when finance_person then null when list_ok then l_target_category
       when has_rule then r_target_category end as primary_category,
  case when vip_hit then 'review' when finance_person then null when list_ok then l_recommended_action
       when has_rule then coalesce(nullif(r_recommended_action, ''), 'review') end as recommended_action,
  cast(case when vip_hit then 95 when finance_person then null when list_ok then 95
       when has_rule then coalesce(nullif(r_prec, 0), 90) end as int) as confidence,
  cast(case when vip_hit then 90 when finance_person then null
       when list_ok then least((case when l_priority = 10 then 80 when l_priority = 20 then 60 else 40 end) + 15, 100)
       when has_rule then least((case when r_priority = 10 then 80 when r_priority = 20 then 60 else 40 end)
            + coalesce(case when r_prec >= 95 then 10 when r_prec >= 90 then 5 else 0 end, 0), 100)
       end as int) as priority_score,
  case when vip_hit then 'vip_personal' when finance_person then null when list_ok then l_list_type end as list_type,
  case when vip_hit then null when finance_person then null when list_ok then l_identifier_value
       when has_rule then r_key_value end as matched_value,
  case when vip_hit or finance_person or list_ok then null when has_rule then r_feature end as rule_feature,
  case when finance_person and not vip_hit then 'vip finance domain but personal sender'
       when not list_ok and not vip_hit and not has_rule then 'no matching rules or contacts' end as reason
from m"""


SQL_GATEWAY = _sql_gateway()


@register("gateway_decisions", ops="K8 C13 C14 C15 C19 T11-T16", uses="mail list_entry rule",
          sql=SQL_GATEWAY)
def gateway_decisions(fx) -> DataFrame:
    return gateway(fx.mail, fx.list_entry, fx.rule)


@register("match_coverage", ops="I34 D3 D4 E3", uses="mail list_entry rule", sql=f"""
with g as ({SQL_GATEWAY}),
s as (select case when classification_source like 'contact_lists%' then 'lists'
                  when classification_source = 'classification_rules' then 'rules' else 'unmatched' end as decided_by,
        count(*) as message_count from g group by 1)
select decided_by, message_count, {sql_ratio('message_count', 'sum(message_count) over ()', 1)} as share_pct from s""")
def match_coverage(fx) -> DataFrame:
    from triage.operators.aggregates import with_share_of_total
    g = gateway(fx.mail, fx.list_entry, fx.rule)
    by = (F.when(c("classification_source").startswith("contact_lists"), "lists")
          .when(c("classification_source") == "classification_rules", "rules").otherwise("unmatched"))
    agg = g.groupBy(by.alias("decided_by")).agg(F.count(F.lit(1)).alias("message_count"))
    return with_share_of_total(agg, "message_count", "share_pct", 1)


@register("gateway_daily_share", ops="I26 D3 D4 D10 B11", uses="mail list_entry rule", sql=f"""
with g as ({SQL_GATEWAY})
select cast(e.received_datetime as date) as day, count(*) as total,
  count(*) filter (where g.matched) as rule_engine, count(*) filter (where not g.matched) as model,
  {sql_ratio('count(*) filter (where g.matched)', 'count(*)', 1)} as rule_engine_pct
from g join mail e on e.message_id = g.message_id
where e.received_datetime >= timestamp '2024-01-31 00:00:00' - interval '30' day
group by 1""")
def gateway_daily_share(fx, as_of: str = "2024-01-31 00:00:00", days: int = 30) -> DataFrame:
    g = gateway(fx.mail, fx.list_entry, fx.rule)
    m = fx.mail.filter(c("received_datetime") >= F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)))
    n = F.count(F.lit(1))
    return (g.join(m.select("message_id", "received_datetime"), "message_id")
            .groupBy(F.to_date("received_datetime").alias("day"))
            .agg(n.alias("total"), F.count_if(c("matched")).alias("rule_engine"),
                 F.count_if(~c("matched")).alias("model"),
                 ratio(F.count_if(c("matched")), n, 1).alias("rule_engine_pct")))


# --- B13 / K26: composite seed rules ------------------------------------------------------

# fixed values: composite seed conditions (synthetic values for the fixture domains)
SEED_TAXONOMY = ("personal_communication", "industry_news", "internal", "regulatory")
SEED_CONDITIONS = {
    "personal_communication": {"type": "and", "all": [
        {"field": "precedence", "op": "!=", "value": "bulk"},
        {"field": "has_unsubscribe", "op": "=", "value": False},
        {"field": "to_count", "op": "<=", "value": 3}]},
    "industry_news": {"type": "or", "any": [
        {"field": "from_domain", "op": "in", "value": ["d1.example.com", "d4.example.com"]},
        {"field": "subject", "op": "ilike_any", "value": ["%daily briefing%", "%view report%", "%industry%"]}]},
    "internal": {"type": "and", "all": [
        {"field": "from_domain", "op": "ends_with", "value": "3.example.com"},
        {"field": "precedence", "op": "!=", "value": "bulk"}]},
    "regulatory": {"type": "or", "any": [
        {"field": "from_domain", "op": "in", "value": ["d9.example.com", "d19.example.com"]},
        {"field": "subject", "op": "ilike_any", "value": ["%regulator%", "%compliance%", "%signup%"]}]},
}
SEED_PRIORITY = 50


def _sql_rules_pub() -> str:
    from triage.plans.mining import SQL_RULES_PUB
    return SQL_RULES_PUB


_SQL_RULES_PUB = _sql_rules_pub()


def _field(name: str) -> Column:
    if name == "has_unsubscribe":
        return c("unsubscribe_link").isNotNull()
    if name == "from_domain":
        return F.lower(c("from_domain"))
    return c(name)


def compile_condition(cond: dict) -> Column:
    """Compile a composite condition (and/or over field-op-value) into one boolean Column."""
    if cond.get("type") in ("and", "or"):
        parts = [compile_condition(x) for x in cond.get("all", cond.get("any", []))]
        out = parts[0]
        for p in parts[1:]:
            out = (out & p) if cond["type"] == "and" else (out | p)
        return out
    f, op, v = _field(cond["field"]), cond["op"], cond["value"]
    if op == "=":
        return f == F.lit(v)
    if op == "!=":
        return f != F.lit(v)
    if op == "<=":
        return f <= F.lit(v)
    if op == "in":
        return f.isin(list(v))
    if op == "ilike_any":
        out = f.ilike(v[0])
        for p in v[1:]:
            out = out | f.ilike(p)
        return out
    if op == "ends_with":
        return f.endswith(F.lit(v))
    raise ValueError(f"unknown operator {op}")


def _sql_field(name: str) -> str:
    return {"has_unsubscribe": "(unsubscribe_link is not null)", "from_domain": "lower(from_domain)"}.get(name, name)


def compile_condition_sql(cond: dict) -> str:
    if cond.get("type") in ("and", "or"):
        parts = [compile_condition_sql(x) for x in cond.get("all", cond.get("any", []))]
        return "(" + f" {cond['type']} ".join(parts) + ")"
    f, op, v = _sql_field(cond["field"]), cond["op"], cond["value"]
    lit = lambda x: ("true" if x else "false") if isinstance(x, bool) else (
        str(x) if isinstance(x, (int, float)) else "'" + str(x).replace("'", "''") + "'")
    if op in ("=", "!=", "<="):
        return f"({f} {'<>' if op == '!=' else op} {lit(v)})"
    if op == "in":
        return f"({f} in ({', '.join(lit(x) for x in v)}))"
    if op == "ilike_any":
        return "(" + " or ".join(f"{f} ilike {lit(p)}" for p in v) + ")"
    if op == "ends_with":
        return f"ends_with({f}, {lit(v)})"
    raise ValueError(op)


@register("composite_rules", ops="B13 B9 B8 B16", uses="mail", sql="select message_id, rule_name, target_category "
          "from (" + " union all ".join(
              f"select message_id, 'SEED_{cat}' as rule_name, '{cat}' as target_category from mail "
              f"where coalesce({compile_condition_sql(cond)}, false)" for cat, cond in SEED_CONDITIONS.items()) + ") x")
def composite_rules(fx) -> DataFrame:
    """Mail x compiled composite rules: one column expression per rule, exploded matches."""
    hits = F.array(*[F.when(F.coalesce(compile_condition(cond), F.lit(False)),
                            F.struct(F.lit(f"SEED_{cat}").alias("rule_name"), F.lit(cat).alias("target_category")))
                     for cat, cond in SEED_CONDITIONS.items()])
    return (fx.mail.select("message_id", F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("h"))
            .select("message_id", "h.rule_name", "h.target_category"))


@register("seed_rules", ops="K26 C3 A2 A3", uses="mail decision content header rule", sql=_SQL_RULES_PUB + """,
taxonomy as (select unnest(['""" + "', '".join(SEED_TAXONOMY) + """']) as cat),
missing as (select t.cat from taxonomy t left join rules_pub cr on cr.target_category = t.cat
            where cr.target_category is null)
select sha256('seed_v1|' || cat) as id, 'seed_v1' as version, false as is_active, cat as target_category,
  'SEED_' || cat as notes, 'composite' as rule_type, """ + str(SEED_PRIORITY) + """ as priority,
  case cat """ + " ".join(f"when '{k}' then '{json.dumps(v, sort_keys=True)}'" for k, v in SEED_CONDITIONS.items())
          + """ end as condition_json
from missing""")
def seed_rules(fx) -> DataFrame:
    """Inactive composite rule rows for taxonomy categories that have no rule yet."""
    spark = fx.spark
    tax = spark.createDataFrame([(t, json.dumps(SEED_CONDITIONS[t], sort_keys=True)) for t in SEED_TAXONOMY],
                                "cat string, condition_json string")
    from triage.plans.mining import published_rules
    used = published_rules(fx).select(c("target_category").alias("cat")).distinct()
    missing = tax.join(used, "cat", "left_anti")
    return missing.select(
        F.sha2(F.concat(F.lit("seed_v1|"), c("cat")), 256).alias("id"), F.lit("seed_v1").alias("version"),
        F.lit(False).alias("is_active"), c("cat").alias("target_category"),
        F.concat(F.lit("SEED_"), c("cat")).alias("notes"), F.lit("composite").alias("rule_type"),
        F.lit(SEED_PRIORITY).alias("priority"), "condition_json")


# --- K30: folder routing ------------------------------------------------------------

@register("folder_routing", ops="K30 B14", uses="mail list_entry rule", sql=f"""
with g as ({SQL_GATEWAY})
select g.message_id, g.classification_source,
  case when e.is_deleted then 'deleted'
       when g.recommended_action = 'delete' then 'trash'
       when g.recommended_action = 'archive' or (g.recommended_action = 'read' and coalesce(e.flag_status, '') <> 'flagged')
         then 'archive'
       else 'inbox' end as folder_location
from g join mail e on e.message_id = g.message_id""")
def folder_routing(fx) -> DataFrame:
    """Inbox keeps mail that needs action; the rest is routed by the decision (documented policy)."""
    g = gateway(fx.mail, fx.list_entry, fx.rule)
    m = fx.mail.select("message_id", "is_deleted", "flag_status")
    act = c("recommended_action")
    folder = (F.when(c("is_deleted"), "deleted").when(act == "delete", "trash")
              .when((act == "archive") | ((act == "read") & (F.coalesce(c("flag_status"), F.lit("")) != "flagged")),
                    "archive")
              .otherwise("inbox"))
    return g.join(m, "message_id").select("message_id", "classification_source", folder.alias("folder_location"))


# --- I31: process-log tail ----------------------------------------------------------

@register("process_log_tail", ops="I31 A8 F4 D1", uses="mail list_entry rule", sql=f"""
with g as ({SQL_GATEWAY}),
runs as (
  select 'gateway_rule_application' as workflow_name, cast(e.received_datetime as date) as run_day,
    count(*) as processed, count(*) filter (where g.matched) as matched
  from g join mail e on e.message_id = g.message_id group by 2)
select workflow_name, run_day, processed, matched from runs order by run_day desc limit 5""")
def process_log_tail(fx, n: int = 5) -> DataFrame:
    """The job log as the gateway would append it (one run per day of mail), newest first."""
    g = gateway(fx.mail, fx.list_entry, fx.rule)
    log = (g.join(fx.mail.select("message_id", "received_datetime"), "message_id")
           .groupBy(F.to_date("received_datetime").alias("run_day"))
           .agg(F.count(F.lit(1)).alias("processed"), F.count_if(c("matched")).alias("matched"))
           .select(F.lit("gateway_rule_application").alias("workflow_name"), "run_day", "processed", "matched"))
    return log.orderBy(c("run_day").desc()).limit(n)
