"""Rule versions as of a time and exact heavy hitters.

A domain's rule is written after each day with enough of its decisions: the day's majority category from
the next midnight on, or no category (the rule is withdrawn) where the majority is too thin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.operators.asof import as_of_join, validity
from triage.operators.frequent import most_frequent
from triage.plans.reports import LAB, labelled
from triage.registry import register

c = F.col

LEAST, SHARE = 3, 90  # decisions of a day; percent of them that the majority must have

SQL_WRITES = f"""
lab as (select e.message_id, ei.decided_at, lower(e.from_domain) as domain, ei.primary_category from {LAB}
        where ei.primary_category is not null and e.is_deleted = false),
cells as (select domain, cast(decided_at as date) as day, primary_category, count(*) as n from lab where domain is not null and decided_at is not null group by all),
best as (select domain, day, primary_category, n, sum(n) over (partition by domain, day) as total from cells
         qualify row_number() over (partition by domain, day order by n desc, primary_category) = 1),
writes as (select domain, cast(day + 1 as timestamp) as since, case when 100 * n >= {SHARE} * total then primary_category end as rule_category
           from best where total >= {LEAST})"""


def domain_decisions(fx) -> DataFrame:
    return labelled(fx).select("message_id", "decided_at", F.lower("from_domain").alias("domain"), "primary_category")


def rule_writes(lab: DataFrame, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """(domain, since, rule_category) written after each day with ``least`` decisions of a domain."""
    cells = lab.filter(c("domain").isNotNull() & c("decided_at").isNotNull()).groupBy(
        "domain", F.to_date("decided_at").alias("day"), "primary_category").agg(F.count(F.lit(1)).alias("n"))
    days = cells.groupBy("domain", "day").agg(
        F.sum("n").alias("total"), F.min(F.struct((-c("n")).alias("n"), "primary_category")).alias("b"))
    return days.filter(c("total") >= least).select(
        "domain", F.date_add("day", 1).cast("timestamp_ntz").alias("since"),
        F.when(-c("b.n") * 100 >= share * c("total"), c("b.primary_category")).alias("rule_category"))


@register("decisions_as_of", ops="I28 A3 C2 E4", uses="mail decision", sql=f"""
with {SQL_WRITES}
select lab.message_id, lab.decided_at, lab.domain, lab.primary_category, w.since as version_since, w.rule_category,
  w.rule_category = lab.primary_category as agrees
from lab left join lateral (select * from writes where writes.domain = lab.domain and writes.since <= lab.decided_at
                            order by since desc limit 1) w on true""")
def decisions_as_of(fx) -> DataFrame:
    """Each decision with the version of its domain's rule that was active when it was made."""
    lab = domain_decisions(fx)
    held = validity(rule_writes(lab), "domain", "since", ["rule_category"])
    return as_of_join(lab, held, "domain", "decided_at", "since").select(
        "message_id", "decided_at", "domain", "primary_category", c("since").alias("version_since"), "rule_category",
        (c("rule_category") == c("primary_category")).alias("agrees"))


@register("rule_version_changes", ops="K27 E1 I28", uses="mail decision", sql=f"""
with {SQL_WRITES},
steps as (select domain, since, rule_category, lead(since) over w as until, lag(rule_category) over w as before, row_number() over w as nr
          from writes window w as (partition by domain order by since))
select domain, since, until, before, rule_category from steps where nr > 1 and before is distinct from rule_category""")
def rule_version_changes(fx) -> DataFrame:
    """Versions that differ from the one before them, with their validity."""
    held = validity(rule_writes(domain_decisions(fx)), "domain", "since", ["rule_category"])
    over = "over (partition by domain order by since)"
    return held.select("*", F.expr(f"lag(rule_category) {over}").alias("before"), F.expr(f"row_number() {over}").alias("nr")).filter(
        (c("nr") > 1) & ~c("before").eqNullSafe(c("rule_category"))).select("domain", "since", "until", "before", "rule_category")


@register("keywords_frequent", ops="I7 D10 F4", uses="mail decision", sql=f"""
select word as keyword, count(*) as occurrences
from (select unnest(string_split(lower(e.subject), ' ')) as word from {LAB}
      where ei.primary_category is not null and e.subject is not null and e.is_deleted = false) w
where length(word) > 3 group by word order by occurrences desc, keyword limit 30""")
def keywords_frequent(fx, top_n: int = 30, tracked: int = 10_000) -> DataFrame:
    """Most frequent subject words over all categories, through a bounded summary and an exact recount."""
    words = (labelled(fx).filter(c("subject").isNotNull())
             .select(F.explode(F.split(F.lower("subject"), " ")).alias("keyword")).filter(F.length("keyword") > 3))
    return most_frequent(words, "keyword", top_n, "occurrences", tracked)
