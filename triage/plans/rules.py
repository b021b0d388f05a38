"""Rule and contact-list listings, usage reports and inserts.

Rules and lists are configuration-sized; usage reports aggregate the decision fact table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage import AS_OF
from triage.functions.numeric import avg_round, ratio, sql_avg_round, sql_ratio
from triage.operators.aggregates import distinct_joined, row_numbers
from triage.operators.writes import insert_if_absent, inserted_rows
from triage.plans.mining import (RULES_PUB_USES, SQL_RULES_PUB, accepted_rules, publish_rows, published_rules,
                                 rule_metrics, version_stamp)
from triage.registry import register

c = F.col

# fixed values: display orders of the reference listings
FEATURE_ORDER = ("from_address", "sender_address", "from_domain", "message_id_domain", "list_domain", "unsub_domain")
LIST_SUMMARY_ORDER = ("vip_finance", "vip_personal", "personal", "business_critical", "internal")
LIST_LISTING_ORDER = ("vip_personal", "personal", "vip_finance", "business_critical", "internal")


def _rank(col: str, values) -> F.Column:
    e = F.lit(None).cast("int")
    for i, v in reversed(list(enumerate(values, 1))):
        e = F.when(c(col) == v, F.lit(i)).otherwise(e)
    return e


def _sql_rank(col: str, values) -> str:
    return "case " + col + " " + " ".join(f"when '{v}' then {i}" for i, v in enumerate(values, 1)) + " end"


LIST_KEY = ["list_type", "identifier_type", "identifier_value"]
SQL_LISTS_PUB = """prop as (
  select distinct 'internal' as list_type, 'from_domain' as identifier_type, lower(e.from_domain) as identifier_value,
    'internal' as target_category, 'review' as recommended_action, 20 as priority, true as is_active
  from mail e join decision d on d.message_id = e.message_id
  where d.primary_category = 'internal' and e.from_domain is not null),
added as (select p.* from prop p where not exists (select 1 from list_entry l where l.list_type = p.list_type
  and l.identifier_type = p.identifier_type and l.identifier_value = p.identifier_value)),
lists_pub as (select * from list_entry union all select * from added)"""
LISTS_PUB_USES = "mail decision list_entry"


def list_proposals(fx) -> DataFrame:
    """Internal-domain entries proposed from the data: domains of mail decided 'internal'."""
    return (fx.mail.filter(c("from_domain").isNotNull()).join(
        fx.decision.filter(c("primary_category") == "internal").select("message_id"), "message_id", "left_semi")
        .select(F.lit("internal").alias("list_type"), F.lit("from_domain").alias("identifier_type"),
                F.lower("from_domain").alias("identifier_value"), F.lit("internal").alias("target_category"),
                F.lit("review").alias("recommended_action"), F.lit(20).alias("priority"),
                F.lit(True).alias("is_active")).distinct())


def published_lists(fx) -> DataFrame:
    """The curated lists after inserting the data's proposals (existing keys kept)."""
    return insert_if_absent(fx.list_entry, list_proposals(fx), LIST_KEY)


# --- I15 ---------------------------------------------------------------------

@register("rule_version_totals", ops="I15 G1 C8", uses=RULES_PUB_USES, sql=SQL_RULES_PUB + f"""
select 'NEW RULES' as type, count(*) as rules_count from rules_pub where version = '{version_stamp()}' and is_active = true
union all select 'EXISTING RULES', count(*) from rules_pub where version <> '{version_stamp()}' and is_active = true
union all select 'TOTAL ACTIVE', count(*) from rules_pub where is_active = true""")
def rule_version_totals(fx, new_version: str | None = None) -> DataFrame:
    new_version = new_version or version_stamp()
    a = published_rules(fx).filter(c("is_active") == F.lit(True))
    t = a.agg(F.count_if(c("version") == new_version).alias("NEW RULES"),
              F.count_if(c("version") != new_version).alias("EXISTING RULES"),
              F.count(F.lit(1)).alias("TOTAL ACTIVE"))
    return t.unpivot([], t.columns, "type", "rules_count")


@register("rule_category_features", ops="I15 D6", uses=RULES_PUB_USES, sql=SQL_RULES_PUB + f"""
select target_category, count(*) as rule_count, string_agg(distinct feature, ', ' order by feature) as features_used
from rules_pub where version = '{version_stamp()}' and is_active = true group by target_category""")
def rule_category_features(fx, new_version: str | None = None) -> DataFrame:
    new_version = new_version or version_stamp()
    r = published_rules(fx).filter((c("version") == new_version) & (c("is_active") == F.lit(True)))
    n = r.groupBy("target_category").agg(F.count(F.lit(1)).alias("rule_count"))
    return n.join(distinct_joined(r, ["target_category"], "feature", ", ", "features_used"), "target_category", "left")


@register("rule_listing", ops="I15 F3", uses=RULES_PUB_USES, sql=SQL_RULES_PUB + f"""
select cast(row_number() over (order by target_category, {_sql_rank('feature', FEATURE_ORDER)} nulls last, key_value)
  as int) as pos,
  target_category, feature, key_value, recommended_action, priority
from rules_pub where version = '{version_stamp()}' and is_active = true""")
def rule_listing(fx, new_version: str | None = None) -> DataFrame:
    """Ordered listing of one published version; the CASE order is materialised as ``pos`` (a
    window over one version's rules, at most the mining cap)."""
    from pyspark.sql import Window
    new_version = new_version or version_stamp()
    r = published_rules(fx).filter((c("version") == new_version) & (c("is_active") == F.lit(True)))
    w = Window.orderBy("target_category", _rank("feature", FEATURE_ORDER).asc_nulls_last(), "key_value")
    return r.select(F.row_number().over(w).alias("pos"), "target_category", "feature", "key_value",
                    "recommended_action", "priority")


# --- I16 / I17 / I32: contact lists --------------------------------------------------

@register("list_summary", ops="I16 D6 F3", uses=LISTS_PUB_USES, sql="with " + SQL_LISTS_PUB + """
select list_type, count(*) as contact_count,
  string_agg(distinct target_category, ', ' order by target_category) as target_categories
from lists_pub where is_active = true group by list_type""")
def list_summary(fx) -> DataFrame:
    a = published_lists(fx).filter(c("is_active") == F.lit(True))
    n = a.groupBy("list_type").agg(F.count(F.lit(1)).alias("contact_count"))
    return (n.join(distinct_joined(a, ["list_type"], "target_category", ", ", "target_categories"), "list_type", "left")
            .orderBy(_rank("list_type", LIST_SUMMARY_ORDER).asc_nulls_last()))


@register("list_listing", ops="I16 F3", uses=LISTS_PUB_USES, sql="with " + SQL_LISTS_PUB + f"""
select cast(row_number() over (order by {_sql_rank('list_type', LIST_LISTING_ORDER)} nulls last, priority,
  identifier_value) as int) as pos, list_type, identifier_type, identifier_value, target_category, priority
from lists_pub where is_active = true""")
def list_listing(fx) -> DataFrame:
    a = published_lists(fx).filter(c("is_active") == F.lit(True))
    groups = {"_g1": F.coalesce(_rank("list_type", LIST_LISTING_ORDER), F.lit(1 << 30)), "_g2": c("priority"),
              "_g3": F.left("identifier_value", F.lit(2))}
    return row_numbers(a, groups, ["identifier_value"]).select(
        "pos", "list_type", "identifier_type", "identifier_value", "target_category", "priority")


@register("active_lists", ops="I17 F1", uses=LISTS_PUB_USES, sql="with " + SQL_LISTS_PUB + """
select cast(row_number() over (order by priority, list_type, identifier_value) as int) as pos, list_type, identifier_type,
  identifier_value, target_category, recommended_action, priority
from lists_pub where is_active = true""")
def active_lists(fx) -> DataFrame:
    """The matcher's load: active entries in (priority, list_type) order (T16 tie-break added)."""
    a = published_lists(fx).filter(c("is_active") == F.lit(True))
    groups = {"_g1": c("priority"), "_g2": c("list_type"), "_g3": F.left("identifier_value", F.lit(2))}
    return row_numbers(a, groups, ["identifier_value"]).select(
        "pos", "list_type", "identifier_type", "identifier_value", "target_category", "recommended_action", "priority")


@register("contact_lookup", ops="I32 B9", uses="list_entry mail", sql="""
with frag as (select distinct lower(split_part(from_address, '@', 1)) as f from mail
              where position('@' in from_address) > 0)
select l.list_type, l.identifier_type, l.identifier_value, f.f as fragment
from list_entry l join frag f on l.identifier_value ilike '%' || f.f || '%' where l.is_active = true""")
def contact_lookup(fx, fragment: str | None = None) -> DataFrame:
    """Which list entries a searched ``fragment`` hits (ILIKE '%x%'); without one, those of every
    local part in the mail table, by the substring equi-join."""
    from triage.operators.joins import contains_join
    frag = (fx.mail.filter(F.instr("from_address", "@") > 0)
            .select(F.lower(F.split_part("from_address", F.lit("@"), F.lit(1))).alias("fragment")).distinct())
    if fragment is not None:
        frag = fx.spark.range(1).select(F.lower(F.lit(fragment)).alias("fragment"))
    lists = fx.list_entry.filter(c("is_active") == F.lit(True)).select(
        "list_type", "identifier_type", "identifier_value", F.lower("identifier_value").alias("_v"))
    return contains_join(lists, "_v", frag, "fragment").select(
        "list_type", "identifier_type", "identifier_value", "fragment")


@register("list_counts", ops="I32 D1", uses=LISTS_PUB_USES, sql="with " + SQL_LISTS_PUB + """
select list_type, count(*) as n from lists_pub where is_active = true group by list_type""")
def list_counts(fx) -> DataFrame:
    return published_lists(fx).filter(c("is_active") == F.lit(True)).groupBy("list_type").agg(
        F.count(F.lit(1)).alias("n"))


# --- A3: inserts that keep existing keys --------------------------------------------------

@register("list_insert_if_absent", ops="A3 C3", uses=LISTS_PUB_USES, sql="with " + SQL_LISTS_PUB + """
select * from added""")
def list_insert_if_absent(fx) -> DataFrame:
    """Rows a proposal adds to the curated lists; existing (type, identifier) keys are kept."""
    return inserted_rows(fx.list_entry, list_proposals(fx), LIST_KEY)


@register("rules_insert_if_absent", ops="A3 K6", uses="mail decision content header rule")
def rules_insert_if_absent(fx) -> DataFrame:
    """Published mining rows that a DO NOTHING insert would add on (version, feature, key)."""
    pub = publish_rows(accepted_rules(rule_metrics(fx)))
    return inserted_rows(fx.rule, pub.select("version", "feature", "key_value", "target_category",
                                             "recommended_action", "priority", "is_active", "support",
                                             "precision_cat_pct"),
                         ["version", "feature", "key_value"])


# --- I26-I28: usage -----------------------------------------------------------------

def _ts(ts: str):
    return F.lit(ts).cast("timestamp_ntz")


@register("daily_engine_share", ops="I26 D3 D4 D10 B11 B3", uses="decision", sql=f"""
select cast(decided_at as date) as day,
  count(*) filter (where model_name = 'rule_engine') as rule_classifications,
  count(*) filter (where model_name <> 'rule_engine') as ai_classifications,
  {sql_ratio("count(*) filter (where model_name = 'rule_engine')", 'count(*)', 1)} as rule_percentage
from decision where decided_at >= timestamp '{AS_OF}' - interval '7' day group by 1""")
def daily_engine_share(fx, as_of: str = AS_OF, days: int = 7) -> DataFrame:
    d = fx.decision.filter(c("decided_at") >= _ts(as_of) - F.make_dt_interval(F.lit(days)))
    rule = c("model_name") == "rule_engine"
    return d.groupBy(F.to_date("decided_at").alias("day")).agg(
        F.count_if(rule).alias("rule_classifications"), F.count_if(~rule).alias("ai_classifications"),
        ratio(F.count_if(rule), F.count(F.lit(1)), 1).alias("rule_percentage"))


@register("top_rules_7d", ops="I27 D1 F4", uses="decision", sql=f"""
select rule_conditions, primary_category, count(*) as usage_count, {sql_avg_round('confidence')} as avg_confidence
from decision where model_name = 'rule_engine' and decided_at >= timestamp '{AS_OF}' - interval '7' day
group by 1, 2 order by usage_count desc, rule_conditions, primary_category limit 10""")
def top_rules_7d(fx, as_of: str = AS_OF, days: int = 7, n: int = 10) -> DataFrame:
    d = fx.decision.filter((c("model_name") == "rule_engine")
                           & (c("decided_at") >= _ts(as_of) - F.make_dt_interval(F.lit(days))))
    return (d.groupBy("rule_conditions", "primary_category")
            .agg(F.count(F.lit(1)).alias("usage_count"), avg_round(c("confidence")).alias("avg_confidence"))
            .orderBy(c("usage_count").desc(), c("rule_conditions").asc_nulls_first(), "primary_category").limit(n))


@register("decisions_by_version", ops="I28 D1", uses="decision", sql=f"""
select rules_version, count(*) as decisions, {sql_avg_round('confidence')} as avg_confidence
from decision where model_name <> 'rule_engine' group by rules_version""")
def decisions_by_version(fx) -> DataFrame:
    return (fx.decision.filter(c("model_name") != "rule_engine").groupBy("rules_version")
            .agg(F.count(F.lit(1)).alias("decisions"), avg_round(c("confidence")).alias("avg_confidence")))
