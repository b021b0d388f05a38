"""The SQL surface of rule snapshots (L1, L2, L5): a table function, a scripted procedure and a view of the session.

``install`` gives a session

* ``get_active_rules_snapshot([as_of])``, a table function: the newest valid snapshot;
* ``rules_cache_status`` (a view) and ``rules_cache_status_at([as_of])``: each snapshot and its state;
* ``rules_snapshots``, the snapshots less what was invalidated;
* an empty log of invalidations, a table in the shared folder that ``invalidate_rules_snapshots`` appends to.

``as_of`` is now where it is left out. Invalidating is a SQL script: Parquet tables know no UPDATE, so
the script logs (version, time, reason) of each snapshot it hits, and ``rules_snapshots`` joins the log by version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triage import AS_OF
from triage.plans.snapshots import SNAPS_USES, SQL_ACTIVE, SQL_INVALIDATE, SQL_STATUS, published_snapshots
from triage.registry import register
from triage.session import checkpoint_dir

OBJECTS = ("""
create or replace temporary view rules_snapshots as
select version, is_active and hit.first is null as is_active, created_at, expires_at,
  coalesce(invalidated_at, hit.first.at) as invalidated_at, hit.first.reason as invalidation_reason, rules_count
from rules_snapshots_built left join
  (select version, min(struct(at, reason)) as first from rules_invalidations group by version) hit using (version)
""", """
create or replace temporary function get_active_rules_snapshot(as_of timestamp_ntz default localtimestamp())
returns table(version string, expires_at timestamp_ntz, rules_count int) return
select version, expires_at, rules_count from rules_snapshots
where is_active and expires_at > get_active_rules_snapshot.as_of and invalidated_at is null
order by created_at desc, version desc limit 1
""", """
create or replace temporary function rules_cache_status_at(as_of timestamp_ntz default localtimestamp())
returns table(version string, is_active boolean, created_at timestamp_ntz, expires_at timestamp_ntz, status string, rules_count int) return
select version, is_active, created_at, expires_at,
  case when invalidated_at is not null then 'invalidated' when expires_at <= rules_cache_status_at.as_of then 'expired'
       when is_active then 'active' else 'inactive' end, rules_count
from rules_snapshots
""", """
create or replace temporary view rules_cache_status as select * from rules_cache_status_at()
""")

INVALIDATE = """
begin
  declare affected int;
  set affected = (select count(*) from rules_snapshots where is_active and invalidated_at is null);
  insert into {log}
    select version, cast(:as_of as timestamp_ntz), :reason from rules_snapshots where is_active and invalidated_at is null;
  select affected;
end
"""


def install(spark: SparkSession, snapshots: DataFrame) -> str:
    """Creates the objects over ``snapshots``; returns the name of the log of invalidations."""
    checkpoint_dir(spark)
    snapshots.checkpoint().createOrReplaceTempView("rules_snapshots_built")  # one row a snapshot, read by each object
    log = f"rules_invalidations_{uuid.uuid4().hex}"
    spark.sql(f"create table {log}(version string, at timestamp_ntz, reason string) using parquet "
              f"location '{checkpoint_dir(spark)}/tables/{log}'")
    spark.sql(f"create or replace temporary view rules_invalidations as select * from {log}")
    for statement in OBJECTS:
        spark.sql(statement)
    return log


def invalidate_rules_snapshots(spark: SparkSession, log: str, reason: str, as_of: str | None = None) -> int:
    """Runs the script; returns how many snapshots it invalidated."""
    at = as_of or spark.sql("select cast(localtimestamp() as string) as at").first()["at"]
    return spark.sql(INVALIDATE.format(log=log), args={"as_of": at, "reason": reason}).first()["affected"]


@register("sql_active_snapshot", ops="L1 K24", uses=SNAPS_USES, sql=SQL_ACTIVE)
def sql_active_snapshot(fx) -> DataFrame:
    """``SELECT * FROM get_active_rules_snapshot(...)``."""
    install(fx.spark, published_snapshots(fx))
    return fx.spark.sql(f"select * from get_active_rules_snapshot(timestamp_ntz'{AS_OF}')")


@register("sql_cache_status", ops="L5 I29", uses=SNAPS_USES, sql=SQL_STATUS)
def sql_cache_status(fx) -> DataFrame:
    """The status view's function at a fixed time."""
    install(fx.spark, published_snapshots(fx))
    return fx.spark.sql(f"select * from rules_cache_status_at(timestamp_ntz'{AS_OF}')")


@register("sql_invalidate", ops="L2 L3 K25", uses=SNAPS_USES, sql=SQL_INVALIDATE)
def sql_invalidate(fx, reason: str = "New CDA rules published") -> DataFrame:
    """The scripted procedure, then the snapshots as the session's view shows them."""
    log = install(fx.spark, published_snapshots(fx))
    n = invalidate_rules_snapshots(fx.spark, log, reason, AS_OF)
    return fx.spark.table("rules_snapshots").withColumn("affected", F.lit(n))
