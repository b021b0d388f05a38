"""Rule snapshots with TTL.

Snapshots are a small versioned table; every function takes ``as_of`` instead of reading the
clock, so results are reproducible. ``build_snapshot`` groups the published rules by category
into DSL text; the text per category is bounded by the (config-sized) rule set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage import AS_OF
from triage.registry import register

c = F.col
TTL_HOURS = 24


def _sql_snaps() -> str:
    from triage.plans.mining import SQL_RULES_PUB
    return SQL_RULES_PUB + f""",
snaps as (
  select version, is_active, created_at, expires_at, invalidated_at, rules_count from snapshot
  union all
  select 'hybrid_{AS_OF[:10]}_r' || cast(count(*) as varchar), true, timestamp '{AS_OF}',
    timestamp '{AS_OF}' + interval '{TTL_HOURS}' hour, cast(null as timestamp), cast(count(*) as int)
  from rules_pub where is_active = true)"""


SNAPS_USES = "mail decision content header rule snapshot"


def published_snapshots(fx, as_of: str = AS_OF) -> DataFrame:
    """Snapshot history plus the snapshot this run builds from the published rules (the
    rule count of the new snapshot comes from the data)."""
    from triage.plans.mining import published_rules
    n = published_rules(fx).filter(c("is_active") == F.lit(True)).agg(F.count(F.lit(1)).cast("int").alias("n"))
    built = n.select(F.concat(F.lit(f"hybrid_{as_of[:10]}_r"), c("n").cast("string")).alias("version"),
                     F.lit(True).alias("is_active"), F.lit(as_of).cast("timestamp_ntz").alias("created_at"),
                     (F.lit(as_of).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(TTL_HOURS))).alias("expires_at"),
                     F.lit(None).cast("timestamp_ntz").alias("invalidated_at"), c("n").alias("rules_count"))
    return fx.snapshot.unionByName(built)


def _ts(ts: str):
    return F.lit(ts).cast("timestamp_ntz")


def cache_status(snap: DataFrame, as_of: str = AS_OF) -> DataFrame:
    status = (F.when(c("invalidated_at").isNotNull(), "invalidated").when(c("expires_at") <= _ts(as_of), "expired")
              .when(c("is_active"), "active").otherwise("inactive"))
    return snap.select("version", "is_active", "created_at", "expires_at", status.alias("status"), "rules_count")


SQL_STATUS = _sql_snaps() + f"""
select version, is_active, created_at, expires_at,
  case when invalidated_at is not null then 'invalidated' when expires_at <= timestamp '{AS_OF}' then 'expired'
       when is_active then 'active' else 'inactive' end as status, rules_count
from snaps"""


@register("snapshot_status", ops="I29 L5 B14 B11", uses=SNAPS_USES, sql=SQL_STATUS)
def snapshot_status(fx) -> DataFrame:
    return cache_status(published_snapshots(fx))


def active_snapshot(snap: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """L1 table function: the newest valid snapshot (ties broken by version, T36)."""
    ok = snap.filter((c("is_active") == F.lit(True)) & (c("expires_at") > _ts(as_of)) & c("invalidated_at").isNull())
    return ok.orderBy(c("created_at").desc(), c("version").desc()).limit(1).select("version", "expires_at", "rules_count")


SQL_ACTIVE = _sql_snaps() + f"""
select version, expires_at, rules_count from snaps
where is_active = true and expires_at > timestamp '{AS_OF}' and invalidated_at is null
order by created_at desc, version desc limit 1"""


@register("snapshot_active", ops="K24 L1 F4", uses=SNAPS_USES, sql=SQL_ACTIVE)
def snapshot_active(fx) -> DataFrame:
    return active_snapshot(published_snapshots(fx))


def invalidate(snap: DataFrame, reason: str, as_of: str = AS_OF) -> tuple[DataFrame, DataFrame]:
    """L2: (new snapshot table, one-row affected count). The caller writes the table."""
    hit = (c("is_active") == F.lit(True)) & c("invalidated_at").isNull()
    new = snap.select("version", F.when(hit, F.lit(False)).otherwise(c("is_active")).alias("is_active"), "created_at",
                      "expires_at", F.when(hit, _ts(as_of)).otherwise(c("invalidated_at")).alias("invalidated_at"),
                      F.when(hit, F.lit(reason)).alias("invalidation_reason"), "rules_count")
    affected = snap.agg(F.count_if(hit).cast("int").alias("affected"))
    return new, affected


SQL_INVALIDATE = _sql_snaps() + f"""
select version, false as is_active, created_at, expires_at,
  case when is_active = true and invalidated_at is null then timestamp '{AS_OF}' else invalidated_at end
    as invalidated_at,
  case when is_active = true and invalidated_at is null then 'New CDA rules published' end as invalidation_reason,
  rules_count, (select cast(count(*) as int) from snaps where is_active = true and invalidated_at is null) as affected
from snaps"""


@register("snapshot_invalidate", ops="K25 L2 L3 A7", uses=SNAPS_USES, sql=SQL_INVALIDATE)
def snapshot_invalidate(fx, reason: str = "New CDA rules published") -> DataFrame:
    new, affected = invalidate(published_snapshots(fx), reason)
    return new.withColumn("affected", affected.scalar())


@register("snapshot_refresh", ops="J7 B11", uses=SNAPS_USES, sql=_sql_snaps() + f"""
select count(*) filter (where is_active = true and expires_at > timestamp '{AS_OF}' and invalidated_at is null) = 0
  as needs_build,
  count(*) filter (where is_active = true and invalidated_at is null and expires_at <= timestamp '{AS_OF}') as expired_active
from snaps""")
def snapshot_refresh(fx, as_of: str = AS_OF) -> DataFrame:
    """TTL check: build a new snapshot when no valid one exists at ``as_of``."""
    s = published_snapshots(fx)
    valid = (c("is_active") == F.lit(True)) & (c("expires_at") > _ts(as_of)) & c("invalidated_at").isNull()
    stale = (c("is_active") == F.lit(True)) & c("invalidated_at").isNull() & (c("expires_at") <= _ts(as_of))
    return s.agg((F.count_if(valid) == 0).alias("needs_build"), F.count_if(stale).alias("expired_active"))


def _precision_label(p):
    return F.when(p >= 90, "high precision").when(p >= 75, "medium precision").otherwise("low precision")


def build_snapshot(rules: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """DSL lines per category plus counts; one row per category."""
    r = rules.filter(c("is_active") == F.lit(True))
    line = F.concat(F.lit("- IF "), c("feature"), F.lit('="'), c("key_value"), F.lit('" -> '), c("target_category"),
                    F.lit(" ("), _precision_label(F.coalesce(c("precision_cat_pct"), F.lit(0))), F.lit(", "),
                    F.coalesce(c("support"), F.lit(0)).cast("string"), F.lit(" hits, action: "),
                    F.coalesce(c("recommended_action"), F.lit("review")), F.lit(")"))
    per = r.groupBy("target_category").agg(
        F.count(F.lit(1)).alias("rules_count"),
        F.sum(F.coalesce(c("support"), F.lit(0))).cast("bigint").alias("total_support"),
        F.round(F.avg(c("precision_cat_pct").cast("decimal(10,2)")), 2).cast("double").alias("avg_precision"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct((-F.coalesce(c("support"), F.lit(0))).alias("s"),
                                                 c("feature"), c("key_value"), line.alias("line")))),
            lambda x: x["line"]), "\n").alias("lines"))
    return per.select(
        "target_category", "rules_count", "total_support", "avg_precision",
        F.concat(F.lit("=== "), F.upper("target_category"), F.lit(" ===\n"), c("lines")).alias("rules_dsl"),
        (_ts(as_of) + F.make_dt_interval(hours=F.lit(TTL_HOURS))).alias("expires_at"))


@register("snapshot_build", ops="K23 D6 D1", uses="mail decision content header rule", sql=_sql_snaps() + f""",
r as (select *, '- IF ' || feature || '="' || key_value || '" -> ' || target_category || ' ('
  || case when coalesce(precision_cat_pct, 0) >= 90 then 'high precision' when coalesce(precision_cat_pct, 0) >= 75
     then 'medium precision' else 'low precision' end || ', ' || cast(coalesce(support, 0) as varchar)
  || ' hits, action: ' || coalesce(recommended_action, 'review') || ')' as line from rules_pub where is_active = true)
select target_category, count(*) as rules_count, cast(sum(coalesce(support, 0)) as bigint) as total_support,
  cast(round(avg(cast(precision_cat_pct as decimal(10,2))), 2) as double) as avg_precision,
  '=== ' || upper(target_category) || ' ===' || chr(10)
    || string_agg(line, chr(10) order by -coalesce(support, 0), feature, key_value) as rules_dsl,
  timestamp '{AS_OF}' + interval '{TTL_HOURS}' hour as expires_at
from r group by target_category""")
def snapshot_build(fx) -> DataFrame:
    from triage.plans.mining import published_rules
    return build_snapshot(published_rules(fx))
