"""Audits and category derivation.

The mail table plays ``emails_ingest``; ``desired_state`` plays the decision store
(``action_decisions``). All joins are on ``message_id``; per-message "latest" lookups are
``max_by`` aggregates (partial, map-side) joined back, never correlated subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triage.operators.writes import upsert
from triage.plans.mining import RULES_PUB_USES, SQL_RULES_PUB, published_rules
from triage.registry import register
from triage.schemas import TAXONOMY

c = F.col



def empty_array() -> Column:
    return F.array().cast(T.ArrayType(T.StringType()))


def sorted_or_empty(col: Column) -> Column:
    """Multiset order-insensitive form; null and empty compare equal."""
    return F.sort_array(F.coalesce(col, empty_array()))


def is_missing(df: DataFrame, name: str) -> Column:
    """Emptiness decided from the column's type at plan time."""
    dt = df.schema[name].dataType
    col = c(name)
    if isinstance(dt, T.ArrayType):
        return col.isNull() | (F.size(F.coalesce(col, empty_array())) == 0)
    if isinstance(dt, T.StringType):
        return col.isNull() | col.isin("", "[]", "{}")
    return col.isNull()


def taxonomy_df(spark) -> DataFrame:
    return spark.createDataFrame([(t,) for t in TAXONOMY], "cat string")


SQL_TAX = "select unnest(['" + "', '".join(TAXONOMY) + "']) as cat"


# --- I18 ---------------------------------------------------------------------

@register("audit_totals", ops="I18 D11 D3 B5 B6 C8", uses="mail decision content desired_state", sql="""
select (select count(*) from mail) as total_emails,
  (select count(*) from content) as analyses,
  (select count(*) from desired_state) as decisions,
  (select count(*) filter (where flag_status is null or flag_status = '') from mail) as missing_flag_status,
  (select count(*) filter (where categories is null or len(categories) = 0) from mail) as missing_categories,
  (select count(*) from desired_state where synced_at is null or sync_status is distinct from 'synced')
    as pending_decisions""")
def audit_totals(fx) -> DataFrame:
    m = fx.mail
    gaps = m.agg(F.count(F.lit(1)).alias("total_emails"),
                 F.count_if(c("flag_status").isNull() | (c("flag_status") == "")).alias("missing_flag_status"),
                 F.count_if(is_missing(m, "categories")).alias("missing_categories"))
    analyses = fx.content.agg(F.count(F.lit(1)).alias("analyses"))
    dec = fx.desired_state.agg(
        F.count(F.lit(1)).alias("decisions"),
        F.count_if(c("synced_at").isNull() | ~c("sync_status").eqNullSafe(F.lit("synced"))).alias("pending_decisions"))
    # Uncorrelated scalar subqueries as columns (each aggregate has exactly one row)
    d = dec.select(F.struct("decisions", "pending_decisions")).scalar()
    return gaps.select("total_emails", analyses.scalar().alias("analyses"), d["decisions"].alias("decisions"),
                       "missing_flag_status", "missing_categories", d["pending_decisions"].alias("pending_decisions"))


@register("flag_distribution", ops="I18 D1 B16", uses="mail", sql="""
select coalesce(flag_status, '<NULL>') as flag_status, count(*) as n from mail group by 1""")
def flag_distribution(fx) -> DataFrame:
    return fx.mail.groupBy(F.coalesce("flag_status", F.lit("<NULL>")).alias("flag_status")).agg(
        F.count(F.lit(1)).alias("n"))


# --- I19 / I20 -----------------------------------------------------------------

def _mail_vs_desired(fx) -> DataFrame:
    m = fx.mail.select("message_id", "user_upn", c("flag_status").alias("db_flag"), c("categories").alias("db_cats"))
    d = fx.desired_state.select("message_id", c("flag_status").alias("dec_flag"), c("categories").alias("dec_cats"),
                                "sync_status", "synced_at")
    return m.join(d, "message_id")


def _mismatch(flag_col="db_flag", dec_flag="dec_flag"):
    flag = ~c(flag_col).eqNullSafe(c(dec_flag))
    cats = ~sorted_or_empty(c("db_cats")).eqNullSafe(sorted_or_empty(c("dec_cats")))
    return flag, cats


@register("state_mismatch", ops="I19 G3 B4 D3", uses="mail desired_state", sql="""
with cmp as (select e.flag_status as db_flag, d.flag_status as dec_flag,
    list_sort(coalesce(e.categories, []::varchar[])) as a, list_sort(coalesce(d.categories, []::varchar[])) as b
  from mail e join desired_state d on d.message_id = e.message_id)
select count(*) filter (where db_flag is distinct from dec_flag) as flag_mismatch,
  count(*) filter (where a is distinct from b) as categories_mismatch from cmp""")
def state_mismatch(fx) -> DataFrame:
    flag, cats = _mismatch()
    return _mail_vs_desired(fx).agg(F.count_if(flag).alias("flag_mismatch"),
                                    F.count_if(cats).alias("categories_mismatch"))


def first_n(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` messages in key order; None: all of them, unordered."""
    return df if n is None else df.orderBy("message_id").limit(n)


@register("correction_preview", ops="I19 G3 F5 A15", uses="mail desired_state", sql="""
select e.message_id, e.flag_status as db_flag_old, d.flag_status as db_flag_new,
  array_to_string(e.categories, '|') as db_cats_old, array_to_string(d.categories, '|') as db_cats_new
from mail e join desired_state d on d.message_id = e.message_id
where e.flag_status is distinct from d.flag_status
   or list_sort(coalesce(e.categories, []::varchar[])) is distinct from list_sort(coalesce(d.categories, []::varchar[]))
order by e.message_id limit 100""")
def correction_preview(fx, n: int | None = 100) -> DataFrame:
    """The dry-run page of corrections; the reference's unordered LIMIT gets a key order."""
    flag, cats = _mismatch()
    return (first_n(_mail_vs_desired(fx).filter(flag | cats), n)
            .select("message_id", c("db_flag").alias("db_flag_old"), c("dec_flag").alias("db_flag_new"),
                    F.array_join("db_cats", "|").alias("db_cats_old"),
                    F.array_join("dec_cats", "|").alias("db_cats_new")))


@register("push_candidates", ops="I20 C1 B4 F5", uses="mail desired_state", sql="""
select e.message_id, e.user_upn, array_to_string(d.categories, '|') as categories_to_set, d.flag_status as flag_to_set
from mail e join desired_state d on d.message_id = e.message_id
where (d.synced_at is null or d.sync_status is distinct from 'synced')
  and (d.categories is not null or d.flag_status is not null)
order by e.message_id limit 500""")
def push_candidates(fx, n: int | None = 500) -> DataFrame:
    j = _mail_vs_desired(fx)
    return (first_n(j.filter((c("synced_at").isNull() | ~c("sync_status").eqNullSafe(F.lit("synced")))
                             & (c("dec_cats").isNotNull() | c("dec_flag").isNotNull())), n)
            .select("message_id", "user_upn", F.array_join("dec_cats", "|").alias("categories_to_set"),
                    c("dec_flag").alias("flag_to_set")))


@register("audit_report", ops="I21 A14 D12 T19")
def audit_report(fx) -> DataFrame:
    """The combined report as rows (section, item): totals and mismatches, then every correction and
    every candidate as a JSON object of its own, so no array grows with the data."""
    return report_rows([("audit", audit_totals(fx)), ("mismatch", state_mismatch(fx)),
                        ("preview", correction_preview(fx, None)),
                        ("backfill_candidates", push_candidates(fx, None))])


def report_rows(sections: list[tuple[str, DataFrame]]) -> DataFrame:
    """(section, item) rows; an item is a row of its section as a JSON object with nulls."""
    parts = [df.select(F.lit(name).alias("section"),
                       F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("item")) for name, df in sections]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- I22-I25 ---------------------------------------------------------------------

@register("taxonomy_coverage", ops="I22 C16 A2 D3", uses=RULES_PUB_USES, sql=SQL_RULES_PUB + f""",
t as ({SQL_TAX})
select t.cat, count(r.target_category) as rules_count,
  count(r.target_category) filter (where r.is_active) as active_rules
from t left join rules_pub r on r.target_category = t.cat group by t.cat""")
def taxonomy_coverage(fx) -> DataFrame:
    """Rules per taxonomy category in the published rule table (configured + mined)."""
    r = published_rules(fx).groupBy(c("target_category").alias("cat")).agg(
        F.count(F.lit(1)).alias("rules_count"), F.count_if(c("is_active")).alias("active_rules"))
    return (taxonomy_df(fx.spark).join(r, "cat", "left")
            .select("cat", F.coalesce("rules_count", F.lit(0)).alias("rules_count"),
                    F.coalesce("active_rules", F.lit(0)).alias("active_rules")))


def latest_decision(fx) -> DataFrame:
    """Newest decision per message (ties by category, for determinism)."""
    return fx.decision.groupBy("message_id").agg(
        F.max_by("primary_category", F.struct("decided_at", "primary_category")).alias("interest_primary"))


def content_first(fx) -> DataFrame:
    return fx.content.groupBy("message_id").agg(
        F.max_by(F.element_at("categories_found", 1), "analyzed_at").alias("content_primary"))


SQL_LATEST = """latest as (select message_id, arg_max(primary_category, (decided_at, primary_category)) as interest_primary
  from decision group by message_id),
cfirst as (select message_id, arg_max(categories_found[1], analyzed_at) as content_primary from content
  group by message_id)"""


@register("signal_distribution", ops="I23 C6 C16 D10", uses="mail decision content rule", sql=f"""
with t as ({SQL_TAX}), {SQL_LATEST},
r as (select target_category as cat, count(*) as rules, count(*) filter (where is_active) as active
      from rule group by target_category),
signals as (select lower(coalesce(l.interest_primary, cf.content_primary, 'uncategorized')) as cat
  from mail e left join latest l on l.message_id = e.message_id left join cfirst cf on cf.message_id = e.message_id),
s as (select cat, count(*) as examples from signals group by cat)
select t.cat, coalesce(r.rules, 0) as rules_total, coalesce(r.active, 0) as rules_active,
  coalesce(s.examples, 0) as sample_emails
from t left join r on r.cat = t.cat left join s on s.cat = t.cat""")
def signal_distribution(fx) -> DataFrame:
    sig = (fx.mail.select("message_id").join(latest_decision(fx), "message_id", "left")
           .join(content_first(fx), "message_id", "left")
           .select(F.lower(F.coalesce("interest_primary", "content_primary", F.lit("uncategorized"))).alias("cat"))
           .groupBy("cat").agg(F.count(F.lit(1)).alias("sample_emails")))
    r = fx.rule.groupBy(c("target_category").alias("cat")).agg(
        F.count(F.lit(1)).alias("rules_total"), F.count_if(c("is_active")).alias("rules_active"))
    return (taxonomy_df(fx.spark).join(r, "cat", "left").join(sig, "cat", "left")
            .select("cat", F.coalesce("rules_total", F.lit(0)).alias("rules_total"),
                    F.coalesce("rules_active", F.lit(0)).alias("rules_active"),
                    F.coalesce("sample_emails", F.lit(0)).alias("sample_emails")))


def derived_categories(fx) -> DataFrame:
    """Decision store > latest decision > content label > first found; normalised."""
    raw = F.coalesce(F.nullif(c("interest_primary"), F.lit("")), F.nullif(c("content_primary"), F.lit("")))
    low = F.lower(raw)
    cat = F.when(low.isin(list(TAXONOMY)), low).otherwise(F.lit("uncategorized"))
    d = fx.desired_state.select("message_id", c("categories").alias("existing_categories"),
                                c("flag_status").alias("existing_flag"))
    return (fx.mail.select("message_id").join(latest_decision(fx), "message_id", "left")
            .join(content_first(fx), "message_id", "left").join(d, "message_id", "left")
            .select("message_id", cat.alias("primary_category"), "existing_categories", "existing_flag"))


SQL_DERIVED = f"""with {SQL_LATEST},
derived as (
  select e.message_id,
    case when lower(coalesce(nullif(l.interest_primary, ''), nullif(cf.content_primary, '')))
           in ('{"', '".join(TAXONOMY)}')
         then lower(coalesce(nullif(l.interest_primary, ''), nullif(cf.content_primary, '')))
         else 'uncategorized' end as primary_category,
    d.categories as existing_categories, d.flag_status as existing_flag
  from mail e left join latest l on l.message_id = e.message_id left join cfirst cf on cf.message_id = e.message_id
  left join desired_state d on d.message_id = e.message_id)"""


@register("derived_category", ops="I24 C6 B8 B16", uses="mail decision content desired_state", sql=SQL_DERIVED + """
select message_id, primary_category, array_to_string(existing_categories, '|') as existing_categories, existing_flag
from derived""")
def derived_category(fx) -> DataFrame:
    return derived_categories(fx).withColumn("existing_categories", F.array_join("existing_categories", "|"))


@register("decision_upsert", ops="A4 I24 K29", uses="mail decision content desired_state", sql=SQL_DERIVED + """
select d.message_id, d.attention_tier, array_to_string(d.categories, '|') as categories, d.flag_status, d.importance,
  d.sync_status, d.synced_at
from desired_state d where d.message_id not in (select message_id from derived)
union all
select n.message_id, o.attention_tier, n.primary_category as categories,
  coalesce(n.existing_flag, 'notFlagged') as flag_status, o.importance, 'pending' as sync_status, o.synced_at
from derived n left join desired_state o on o.message_id = n.message_id""")
def decision_upsert(fx) -> DataFrame:
    """New decision-store state after upserting every derived category (ON CONFLICT DO UPDATE)."""
    n = derived_categories(fx)
    updates = n.select("message_id", F.array("primary_category").alias("categories"),
                       F.coalesce("existing_flag", F.lit("notFlagged")).alias("flag_status"),
                       F.lit("pending").alias("sync_status"))
    out = upsert(fx.desired_state, updates, ["message_id"], ["categories", "flag_status", "sync_status"])
    return out.withColumn("categories", F.array_join("categories", "|"))


@register("derivation_report", ops="I25 A14 T19 T33")
def derivation_report(fx) -> DataFrame:
    """The combined report as rows (section, item): the expected categories, rules of each, and the
    derived category of every message."""
    coverage = taxonomy_coverage(fx).select(c("cat").alias("category"), c("rules_count").alias("rules"), "active_rules")
    return report_rows([("taxonomy", taxonomy_df(fx.spark)), ("rules_coverage", coverage),
                        ("derivation_preview", derived_categories(fx))])
