"""Mail fixture views derived from the driver tables (see FIXTURES.md).

Each view exists twice: as a Spark DataFrame built with the DataFrame API (what the jobs run
on) and as DuckDB SQL (what the oracles run on). Both are pure projections / filters of the
base tables, so they scale with them; only ``folder`` aggregates (customers per nation).

Arrays are carried as ``|``-separated text in the SQL and split on both sides.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.sources.tables import read_table

c = F.col


def s(name: str) -> Column:
    return c(name).cast("string")


def hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def mins(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def split_bar(col: Column) -> Column:
    return F.split(col, "[|]")


# ---------------------------------------------------------------------------
# Spark views
# ---------------------------------------------------------------------------

def mail(events: DataFrame) -> DataFrame:
    eid, uid = c("event_id"), c("user_id")
    dom = F.concat(F.lit("D"), (uid % 23).cast("string"), F.lit(".Example.com"))
    from_address = (
        F.when(eid % 7 == 0, F.concat(F.lit("News"), s("user_id"), F.lit("+"), c("event_type"), F.lit("@"), dom))
        .when(eid % 7 == 1, F.concat(F.lit("Ann"), s("user_id"), F.lit("@"), dom))
        .when(eid % 7 == 2, F.concat(F.lit('"Some One" <U'), s("user_id"), F.lit(".p@"), dom, F.lit(">")))
        .otherwise(F.concat(F.lit("U"), s("user_id"), F.lit(".p+"), c("event_type"), F.lit("@"), dom))
    )
    return events.select(
        F.concat(F.lit("msg-"), s("event_id")).alias("message_id"),
        F.concat(F.lit("box"), (uid % 5).cast("string"), F.lit("@home.test")).alias("user_upn"),
        c("ts").alias("received_datetime"),
        from_address.alias("from_address"),
        F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(dom).alias("from_domain"),
        F.when(eid % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("relay"), (uid % 17).cast("string"), F.lit("@hub.example.com")))
        .alias("sender_address"),
        F.when(eid % 8 == 5, F.concat(F.lit("Reply"), (uid % 19).cast("string"), F.lit("+x@R"),
                                       (uid % 23).cast("string"), F.lit(".Example.com")))
        .alias("reply_to_address"),
        F.when(eid % 4 == 0, F.concat(F.lit('"News" <L'), (uid % 11).cast("string"), F.lit(".lists.example.com>")))
        .when(eid % 4 == 1, F.concat(F.lit("Plain-"), (uid % 6).cast("string")))
        .alias("list_id"),
        F.when(eid % 5 == 0, F.concat(F.lit("<https://U"), (uid % 9).cast("string"),
                                       F.lit(".example.net/x?y=1>, <mailto:a@b.example.net>")))
        .when(eid % 5 == 1, F.concat(F.lit("<mailto:leave@m"), (uid % 9).cast("string"), F.lit(".example.net>")))
        .alias("unsubscribe_link"),
        F.concat(F.lit("<"), s("event_id"), F.lit("@MX"), (uid % 7).cast("string"), F.lit(".example.org>"))
        .alias("message_id_header"),
        F.when(eid % 6 == 0, F.lit("bulk")).when(eid % 6 == 1, F.lit("Bulk")).alias("precedence"),
        F.when(eid % 12 == 0, F.lit("Auto-Generated")).when(eid % 12 == 7, F.lit("auto-replied"))
        .alias("auto_submitted"),
        F.when(eid % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(c("event_type"), F.lit(" Report, nr "), (uid % 13).cast("string"))).alias("subject"),
        (eid % 41 == 0).alias("is_deleted"),
        (eid % 9 != 0).alias("needs_body"),
        F.when(eid % 2 == 0, c("ts") + hours(2)).alias("analyzed_at"),
        (eid % 10 == 1).alias("auto_processed"),
        (F.lit(1) + eid % 5).cast("int").alias("to_count"),
        split_bar(F.when(eid % 5 == 0, F.lit("Finance|Review")).when(eid % 5 == 1, F.lit("Review"))
                  .when(eid % 5 == 3, F.lit("A|A")).when(eid % 5 == 4, F.lit("A"))).alias("categories"),
        F.when(eid % 4 == 0, F.lit("notFlagged")).when(eid % 4 == 1, F.lit("flagged"))
        .when(eid % 4 == 2, F.lit("")).alias("flag_status"),
    )


def decision(events: DataFrame) -> DataFrame:
    eid, uid, et = c("event_id"), c("user_id"), c("event_type")
    special = (F.when(et == "error", "notifications").when(et == "click", "marketing")
               .when(et == "view", "industry_news").otherwise("uncategorized"))
    k = uid % 23 % 5
    normal = (F.when(k == 0, "financial_news").when(k == 1, "notifications")
              .when(k == 2, "personal_communication").when(k == 3, "internal").otherwise("regulatory"))
    main = events.select(
        F.concat(F.lit("msg-"), s("event_id")).alias("message_id"),
        F.when(eid % 20 == 0, special).otherwise(normal).alias("primary_category"),
        F.when(eid % 15 == 0, F.lit(None).cast("string"))
        .when(uid % 2 == 0, F.lit("review")).otherwise(F.lit("archive")).alias("recommended_action"),
        F.when(eid % 3 == 0, F.lit("rule_engine")).otherwise(F.lit("model_a")).alias("model_name"),
        F.when(eid % 2 == 0, F.lit("v1")).otherwise(F.lit("v2")).alias("rules_version"),
        F.when(eid % 3 == 0, F.concat(F.lit("from_domain:d"), (uid % 23).cast("string"))).alias("rule_conditions"),
        (F.lit(70) + uid % 31).cast("int").alias("confidence"),
        (c("ts") + hours(1)).alias("decided_at"),
    )
    extra = events.filter(eid % 60 == 7).select(
        F.concat(F.lit("msg-"), s("event_id")).alias("message_id"),
        F.lit("business_critical").alias("primary_category"),
        F.lit("review").alias("recommended_action"),
        F.lit("model_b").alias("model_name"),
        F.lit("v2").alias("rules_version"),
        F.lit(None).cast("string").alias("rule_conditions"),
        F.lit(88).cast("int").alias("confidence"),
        (c("ts") + hours(3)).alias("decided_at"),
    )
    return main.unionByName(extra)


def content(events: DataFrame) -> DataFrame:
    eid = c("event_id")
    text = (F.when(eid % 3 == 0, F.lit("Regulatory|marketing"))
            .when(eid % 3 == 1, F.lit("unknown_label")))
    return events.filter(eid % 4 != 3).select(
        F.concat(F.lit("msg-"), s("event_id")).alias("message_id"),
        (c("value") / 500).cast("decimal(6,4)").alias("business_relevance_score"),
        split_bar(text).alias("categories_found"),
        (c("ts") + mins(90)).alias("analyzed_at"),
    )


def header(events: DataFrame) -> DataFrame:
    eid, uid = c("event_id"), c("user_id")
    rp = (F.when(eid % 4 == 0, F.concat(F.lit("<Bounce+"), s("event_id"), F.lit("@R"), (uid % 8).cast("string"),
                                          F.lit(".example.com>")))
          .when(eid % 4 == 1, F.concat(F.lit("Bounce@R"), (uid % 8).cast("string"), F.lit(".example.com")))
          .when(eid % 4 == 2, F.lit("msprvs1=abc")))
    return events.filter(eid % 5 != 4).select(
        F.concat(F.lit("msg-"), s("event_id")).alias("message_id"), rp.alias("return_path"))


# fixed values: synthetic body endings (FIXTURES.md): emoji as two entities, an unpaired one, overlong and
# twice-coded entities; wrapped links of which one is a prefix of the other
ODD_HTML = "<p>&#55357;&#56832;&#55357; &#38;#39; &#39; &#x1F;&#x41; &#99999999999999999999999999;.</p>"
ODD_TEXT = (" see https://a.safelinks.protection.outlook.com/?url=https%3A%2F%2Fx.org and "
            "https://a.safelinks.protection.outlook.com/?url=https%3A%2F%2Fx.org%2Fy&data=1 end")


def body(pages: DataFrame, documents: DataFrame) -> DataFrame:
    odd = lambda key, end: F.when(c(key) % 10 == 3, F.lit(end)).otherwise(F.lit(""))
    html = pages.select(F.concat(F.lit("msg-"), s("page_id")).alias("message_id"),
                        F.concat("html", odd("page_id", ODD_HTML)).alias("content"), F.lit("html").alias("content_type"))
    text = documents.select(F.concat(F.lit("doc-"), s("doc_id")).alias("message_id"),
                            F.concat("text", odd("doc_id", ODD_TEXT)).alias("content"), F.lit("text").alias("content_type"))
    return html.unionByName(text)


def desired_state(events: DataFrame) -> DataFrame:
    eid = c("event_id")
    cats = (F.when(eid % 4 == 0, F.lit("Finance|Review")).when(eid % 4 == 1, F.lit("Review"))
            .when(eid % 4 == 3, F.lit("A|A")))
    return events.filter(eid % 3 == 0).select(
        F.concat(F.lit("msg-"), s("event_id")).alias("message_id"),
        F.when(eid % 2 == 0, F.lit("A")).otherwise(F.lit("B")).alias("attention_tier"),
        split_bar(cats).alias("categories"),
        F.when(eid % 5 == 0, F.lit("flagged")).when(eid % 5 == 1, F.lit("complete"))
        .when(eid % 5 == 2, F.lit(None).cast("string")).otherwise(F.lit("notFlagged")).alias("flag_status"),
        F.when(eid % 6 == 0, F.lit("high")).when(eid % 6 == 1, F.lit(None).cast("string"))
        .otherwise(F.lit("normal")).alias("importance"),
        F.when(eid % 8 == 0, F.lit("pending")).when(eid % 8 == 1, F.lit("failed"))
        .when(eid % 8 == 2, F.lit("user_modified")).otherwise(F.lit("synced")).alias("sync_status"),
        F.when(eid % 7 == 0, F.lit(None)).otherwise(c("ts") + hours(4)).alias("synced_at"),
    )


def observed_state(events: DataFrame) -> DataFrame:
    eid = c("event_id")
    cats = (F.when(eid % 11 == 0, F.lit("Other")).when(eid % 4 == 0, F.lit("Review|Finance"))
            .when(eid % 4 == 1, F.lit("Review")).when(eid % 4 == 3, F.lit("A")))
    return events.filter((eid % 3 == 0) & (eid % 17 != 0)).select(
        F.concat(F.lit("msg-"), s("event_id")).alias("message_id"),
        split_bar(cats).alias("categories"),
        F.when(eid % 13 == 0, F.lit("flagged")).when(eid % 5 == 0, F.lit("flagged"))
        .when(eid % 5 == 1, F.lit("complete")).otherwise(F.lit("notFlagged")).alias("flag_status"),
        F.when(eid % 19 == 0, F.lit("low")).when(eid % 6 == 0, F.lit("high"))
        .otherwise(F.lit("normal")).alias("importance"),
    )


def sender(events: DataFrame) -> DataFrame:
    doms = events.select((c("user_id") % 23).alias("k")).distinct().select(
        F.concat(F.lit("d"), s("k"), F.lit(".example.com")).alias("sender_key"),
        F.concat(F.lit("d"), s("k"), F.lit(".example.com")).alias("sender_domain"),
        F.lit(None).cast("string").alias("sender_address"),
        (F.lit(20) + c("k") * 3).cast("int").alias("confidence_score"),
        (c("k") % 3).cast("int").alias("user_corrections"),
    )
    addr = F.concat(F.lit("u"), s("u"), F.lit(".p@d"), (c("u") % 23).cast("string"), F.lit(".example.com"))
    people = (events.filter(c("user_id") % 10 == 0).select(c("user_id").alias("u")).distinct()
              .select(addr.alias("sender_key"),
                      F.concat(F.lit("d"), (c("u") % 23).cast("string"), F.lit(".example.com")).alias("sender_domain"),
                      addr.alias("sender_address"), F.lit(60).cast("int").alias("confidence_score"),
                      F.lit(0).cast("int").alias("user_corrections")))
    return doms.unionByName(people)


def feedback(events: DataFrame) -> DataFrame:
    return events.filter((c("event_type") == "error") & (c("event_id") % 20 == 3)).select(
        F.concat(F.lit("msg-"), s("event_id")).alias("message_id"),
        F.concat(F.lit("d"), (c("user_id") % 23).cast("string"), F.lit(".example.com")).alias("from_domain"),
        F.lit("category_correction").alias("feedback_type"),
        c("ts").alias("created_at"),
    )


def response(events: DataFrame) -> DataFrame:
    eid = c("event_id")
    m = eid % 8
    code = (F.when(m <= 1, 200).when(m == 2, 204).when(m == 3, 404).when(m == 4, 429)
            .when(m == 5, 500).when(m == 6, 503).otherwise(0))
    return events.select(
        F.concat(F.lit("msg-"), s("event_id")).alias("message_id"),
        code.cast("int").alias("status_code"),
        F.when(eid % 5 == 0, F.lit("30")).when(eid % 5 == 1, F.lit("0")).alias("retry_after"),
    )


def notification(events: DataFrame) -> DataFrame:
    eid = c("event_id")
    payload = F.concat(
        F.lit('{"value":[{"changeType":"'),
        F.when(eid % 2 == 0, F.lit("created")).otherwise(F.lit("updated")),
        F.lit('","clientState":"'), F.when(eid % 29 == 0, F.lit("bad")).otherwise(F.lit("ok")),
        F.lit('","resourceData":{"id":"msg-'), s("event_id"),
        F.lit('"}},{"changeType":"updated","clientState":"ok","resourceData":{"id":"msg-'),
        (eid - eid % 10).cast("string"), F.lit('"}}]}'))
    return events.select(c("event_id"), payload.alias("payload"))


def folder(region: DataFrame, nation: DataFrame, customer: DataFrame) -> DataFrame:
    roots = region.select(
        F.concat(F.lit("r"), s("r_regionkey")).alias("folder_id"), c("r_name").alias("display_name"),
        F.lit(None).cast("string").alias("parent_folder_id"), c("r_name").alias("folder_path"),
        F.lit(0).cast("bigint").alias("total_item_count"), F.lit(0).alias("level"))
    # customers per nation: partial aggregate on the big side, then join two tiny tables
    per_nation = customer.groupBy(c("c_nationkey").alias("n_nationkey")).agg(F.count("c_custkey").alias("n"))
    kids = (nation.join(region, c("r_regionkey") == c("n_regionkey"))
            .join(per_nation, "n_nationkey", "left")
            .select(F.concat(F.lit("n"), s("n_nationkey")).alias("folder_id"), c("n_name").alias("display_name"),
                    F.concat(F.lit("r"), s("n_regionkey")).alias("parent_folder_id"),
                    F.concat(c("r_name"), F.lit("/"), c("n_name")).alias("folder_path"),
                    F.coalesce(c("n"), F.lit(0)).cast("bigint").alias("total_item_count"), F.lit(1).alias("level")))
    return roots.unionByName(kids)


LIST_ENTRY_ROWS = [
    # fixed values: synthetic curated lists (FIXTURES.md)
    ("vip_finance", "from_domain", "d0.example.com", "financial_news", "review", 30, True),
    ("vip_finance", "from_domain", "d5.example.com", "financial_news", "review", 30, True),
    ("vip_personal", "from_address", "u0.p@d0.example.com", "business_critical", "review", 40, True),
    ("personal", "from_address_contains", "ann1", "personal_communication", "review", 15, True),
    ("personal", "from_address", "u7.p@d7.example.com", "personal_communication", "review", 10, True),
    ("business_critical", "from_domain", "d2.example.com", "business_critical", "review", 30, True),
    ("business_critical", "from_domain", "d8.example.com", "business_critical", "review", 30, False),
    ("internal", "from_domain", "d3.example.com", "internal", "review", 20, True),
    ("internal", "list_domain", "l4.lists.example.com", "internal", "read", 30, True),
]
LIST_ENTRY_SCHEMA = ("list_type string, identifier_type string, identifier_value string, target_category string, "
                     "recommended_action string, priority int, is_active boolean")

RULE_ROWS = [
    # fixed values: synthetic published rules with metrics (FIXTURES.md)
    ("v1", "from_domain", "d9.example.com", "notifications", "archive", 30, True, 300, 91),
    ("v1", "message_id_domain", "mx1.example.org", "marketing", "archive", 20, True, 800, 96),
    ("v1", "unsub_domain", "u2.example.net", "financial_news", None, 20, True, 200, 80),
    ("v1", "sender_address", "relay3@hub.example.com", "spam_low_value", "delete", 10, True, 50, 99),
    ("v1", "from_domain", "d10.example.com", "marketing", "archive", 30, False, 120, 97),
    ("v2", "from_domain", "d9.example.com", "industry_news", "review", 30, True, 310, 92),
    ("v2", "from_domain", "d11.example.com", "notifications", "review", 30, True, None, None),
    ("v2", "return_path", "msprvs1=abc", "marketing", "archive", 40, True, 40, 95),
    ("v2", "message_id_domain", "i-0a1b.mta1vrest.sd.prd.sparkpost", "notifications", "archive", 20, True, 9, 100),
]
RULE_SCHEMA = ("version string, feature string, key_value string, target_category string, recommended_action string, "
               "priority int, is_active boolean, support int, precision_cat_pct int")

SNAPSHOT_ROWS = [
    # fixed values: synthetic rule snapshots (FIXTURES.md)
    ("s1", False, "2024-01-28 00:00:00", "2024-01-29 00:00:00", "2024-01-28 12:00:00", 30),
    ("s2", True, "2024-01-29 00:00:00", "2024-01-30 00:00:00", None, 34),
    ("s3", True, "2024-01-30 06:00:00", "2024-01-31 06:00:00", None, 50),
    ("s4", False, "2024-01-30 07:00:00", "2024-01-31 07:00:00", None, 55),
]


def _literal_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    # A2: literal rows. Small config tables; a single-partition local relation.
    return spark.createDataFrame(rows, schema)


def list_entry(spark: SparkSession) -> DataFrame:
    return _literal_rows(spark, LIST_ENTRY_ROWS, LIST_ENTRY_SCHEMA)


def rule(spark: SparkSession) -> DataFrame:
    return _literal_rows(spark, RULE_ROWS, RULE_SCHEMA)


def snapshot(spark: SparkSession) -> DataFrame:
    raw = _literal_rows(spark, SNAPSHOT_ROWS, "version string, is_active boolean, created_at string, "
                                               "expires_at string, invalidated_at string, rules_count int")
    return raw.select("version", "is_active",
                      *[c(x).cast("timestamp_ntz").alias(x) for x in ("created_at", "expires_at", "invalidated_at")],
                      "rules_count")


class Fixtures:
    """Lazily built fixture views for one (session, scale-factor folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def mail(self) -> DataFrame:
        return mail(self.events)

    @cached_property
    def decision(self) -> DataFrame:
        return decision(self.events)

    @cached_property
    def content(self) -> DataFrame:
        return content(self.events)

    @cached_property
    def header(self) -> DataFrame:
        return header(self.events)

    @cached_property
    def body(self) -> DataFrame:
        return body(self.table("pages"), self.table("documents"))

    @cached_property
    def desired_state(self) -> DataFrame:
        return desired_state(self.events)

    @cached_property
    def observed_state(self) -> DataFrame:
        return observed_state(self.events)

    @cached_property
    def sender(self) -> DataFrame:
        return sender(self.events)

    @cached_property
    def feedback(self) -> DataFrame:
        return feedback(self.events)

    @cached_property
    def response(self) -> DataFrame:
        return response(self.events)

    @cached_property
    def notification(self) -> DataFrame:
        return notification(self.events)

    @cached_property
    def folder(self) -> DataFrame:
        return folder(self.table("region"), self.table("nation"), self.table("customer"))

    @cached_property
    def list_entry(self) -> DataFrame:
        return list_entry(self.spark)

    @cached_property
    def rule(self) -> DataFrame:
        return rule(self.spark)

    @cached_property
    def snapshot(self) -> DataFrame:
        return snapshot(self.spark)


# ---------------------------------------------------------------------------
# DuckDB SQL of the same views (oracle side)
# ---------------------------------------------------------------------------

def _values(rows) -> str:
    def lit(v):
        if v is None:
            return "null"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, int):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    return ",\n  ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


SQL: dict[str, str] = {
    "mail": """select 'msg-' || cast(event_id as varchar) as message_id,
  'box' || cast(user_id % 5 as varchar) || '@home.test' as user_upn,
  ts as received_datetime,
  case event_id % 7
    when 0 then 'News' || cast(user_id as varchar) || '+' || event_type || '@D' || cast(user_id % 23 as varchar) || '.Example.com'
    when 1 then 'Ann' || cast(user_id as varchar) || '@D' || cast(user_id % 23 as varchar) || '.Example.com'
    when 2 then '"Some One" <U' || cast(user_id as varchar) || '.p@D' || cast(user_id % 23 as varchar) || '.Example.com>'
    else 'U' || cast(user_id as varchar) || '.p+' || event_type || '@D' || cast(user_id % 23 as varchar) || '.Example.com' end as from_address,
  case when event_id % 97 = 0 then null else 'D' || cast(user_id % 23 as varchar) || '.Example.com' end as from_domain,
  case when event_id % 3 = 0 then null else 'relay' || cast(user_id % 17 as varchar) || '@hub.example.com' end as sender_address,
  case when event_id % 8 = 5 then 'Reply' || cast(user_id % 19 as varchar) || '+x@R' || cast(user_id % 23 as varchar) || '.Example.com' end as reply_to_address,
  case when event_id % 4 = 0 then '"News" <L' || cast(user_id % 11 as varchar) || '.lists.example.com>'
       when event_id % 4 = 1 then 'Plain-' || cast(user_id % 6 as varchar) else null end as list_id,
  case when event_id % 5 = 0 then '<https://U' || cast(user_id % 9 as varchar) || '.example.net/x?y=1>, <mailto:a@b.example.net>'
       when event_id % 5 = 1 then '<mailto:leave@m' || cast(user_id % 9 as varchar) || '.example.net>' else null end as unsubscribe_link,
  '<' || cast(event_id as varchar) || '@MX' || cast(user_id % 7 as varchar) || '.example.org>' as message_id_header,
  case when event_id % 6 = 0 then 'bulk' when event_id % 6 = 1 then 'Bulk' else null end as precedence,
  case when event_id % 12 = 0 then 'Auto-Generated' when event_id % 12 = 7 then 'auto-replied' end as auto_submitted,
  case when event_id % 50 = 0 then null else event_type || ' Report, nr ' || cast(user_id % 13 as varchar) end as subject,
  event_id % 41 = 0 as is_deleted,
  event_id % 9 <> 0 as needs_body,
  case when event_id % 2 = 0 then ts + interval '2' hour else null end as analyzed_at,
  event_id % 10 = 1 as auto_processed,
  cast(1 + event_id % 5 as int) as to_count,
  string_split(case event_id % 5 when 0 then 'Finance|Review' when 1 then 'Review' when 3 then 'A|A' when 4 then 'A' end, '|') as categories,
  case event_id % 4 when 0 then 'notFlagged' when 1 then 'flagged' when 2 then '' else null end as flag_status
from events""",
    "decision": """select 'msg-' || cast(event_id as varchar) as message_id,
  case when event_id % 20 = 0
    then case event_type when 'error' then 'notifications' when 'click' then 'marketing' when 'view' then 'industry_news' else 'uncategorized' end
    else case user_id % 23 % 5 when 0 then 'financial_news' when 1 then 'notifications' when 2 then 'personal_communication' when 3 then 'internal' else 'regulatory' end
  end as primary_category,
  case when event_id % 15 = 0 then null when user_id % 2 = 0 then 'review' else 'archive' end as recommended_action,
  case when event_id % 3 = 0 then 'rule_engine' else 'model_a' end as model_name,
  case when event_id % 2 = 0 then 'v1' else 'v2' end as rules_version,
  case when event_id % 3 = 0 then 'from_domain:d' || cast(user_id % 23 as varchar) else null end as rule_conditions,
  cast(70 + user_id % 31 as int) as confidence,
  ts + interval '1' hour as decided_at
from events
union all
select 'msg-' || cast(event_id as varchar), 'business_critical', 'review', 'model_b', 'v2', null, cast(88 as int), ts + interval '3' hour
from events where event_id % 60 = 7""",
    "content": """select 'msg-' || cast(event_id as varchar) as message_id, cast(value / 500 as decimal(6,4)) as business_relevance_score,
  string_split(case event_id % 3 when 0 then 'Regulatory|marketing' when 1 then 'unknown_label' else null end, '|') as categories_found,
  ts + interval '90' minute as analyzed_at
from events where event_id % 4 <> 3""",
    "header": """select 'msg-' || cast(event_id as varchar) as message_id,
  case event_id % 4 when 0 then '<Bounce+' || cast(event_id as varchar) || '@R' || cast(user_id % 8 as varchar) || '.example.com>'
    when 1 then 'Bounce@R' || cast(user_id % 8 as varchar) || '.example.com' when 2 then 'msprvs1=abc' else null end as return_path
from events where event_id % 5 <> 4""",
    "body": f"""select 'msg-' || cast(page_id as varchar) as message_id,
  html || case when page_id % 10 = 3 then '{ODD_HTML}' else '' end as content, 'html' as content_type from pages
union all
select 'doc-' || cast(doc_id as varchar), text || case when doc_id % 10 = 3 then '{ODD_TEXT}' else '' end, 'text'
from documents""",
    "desired_state": """select 'msg-' || cast(event_id as varchar) as message_id,
  case when event_id % 2 = 0 then 'A' else 'B' end as attention_tier,
  string_split(case event_id % 4 when 0 then 'Finance|Review' when 1 then 'Review' when 2 then null else 'A|A' end, '|') as categories,
  case event_id % 5 when 0 then 'flagged' when 1 then 'complete' when 2 then null else 'notFlagged' end as flag_status,
  case event_id % 6 when 0 then 'high' when 1 then null else 'normal' end as importance,
  case event_id % 8 when 0 then 'pending' when 1 then 'failed' when 2 then 'user_modified' else 'synced' end as sync_status,
  case when event_id % 7 = 0 then null else ts + interval '4' hour end as synced_at
from events where event_id % 3 = 0""",
    "observed_state": """select 'msg-' || cast(event_id as varchar) as message_id,
  string_split(case when event_id % 11 = 0 then 'Other' else case event_id % 4 when 0 then 'Review|Finance' when 1 then 'Review' when 2 then null else 'A' end end, '|') as categories,
  case when event_id % 13 = 0 then 'flagged' else case event_id % 5 when 0 then 'flagged' when 1 then 'complete' else 'notFlagged' end end as flag_status,
  case when event_id % 19 = 0 then 'low' when event_id % 6 = 0 then 'high' else 'normal' end as importance
from events where event_id % 3 = 0 and event_id % 17 <> 0""",
    "sender": """select 'd' || cast(k as varchar) || '.example.com' as sender_key, 'd' || cast(k as varchar) || '.example.com' as sender_domain,
  cast(null as varchar) as sender_address, cast(20 + k * 3 as int) as confidence_score, cast(k % 3 as int) as user_corrections
from (select distinct user_id % 23 as k from events) x
union all
select 'u' || cast(u as varchar) || '.p@d' || cast(u % 23 as varchar) || '.example.com', 'd' || cast(u % 23 as varchar) || '.example.com',
  'u' || cast(u as varchar) || '.p@d' || cast(u % 23 as varchar) || '.example.com', cast(60 as int), cast(0 as int)
from (select distinct user_id as u from events where user_id % 10 = 0) y""",
    "feedback": """select 'msg-' || cast(event_id as varchar) as message_id, 'd' || cast(user_id % 23 as varchar) || '.example.com' as from_domain,
  'category_correction' as feedback_type, ts as created_at
from events where event_type = 'error' and event_id % 20 = 3""",
    "response": """select 'msg-' || cast(event_id as varchar) as message_id,
  cast(case event_id % 8 when 0 then 200 when 1 then 200 when 2 then 204 when 3 then 404 when 4 then 429 when 5 then 500 when 6 then 503 else 0 end as int) as status_code,
  case event_id % 5 when 0 then '30' when 1 then '0' else null end as retry_after
from events""",
    "notification": """select event_id, '{"value":[{"changeType":"' || case when event_id % 2 = 0 then 'created' else 'updated' end
  || '","clientState":"' || case when event_id % 29 = 0 then 'bad' else 'ok' end
  || '","resourceData":{"id":"msg-' || cast(event_id as varchar) || '"}},{"changeType":"updated","clientState":"ok","resourceData":{"id":"msg-'
  || cast(event_id - event_id % 10 as varchar) || '"}}]}' as payload
from events""",
    "folder": """select 'r' || cast(r_regionkey as varchar) as folder_id, r_name as display_name, cast(null as varchar) as parent_folder_id,
  r_name as folder_path, cast(0 as bigint) as total_item_count, 0 as level from region
union all
select 'n' || cast(n_nationkey as varchar), n_name, 'r' || cast(n_regionkey as varchar), r_name || '/' || n_name,
  cast(count(c_custkey) as bigint), 1
from nation join region on r_regionkey = n_regionkey left join customer on c_nationkey = n_nationkey
group by n_nationkey, n_name, n_regionkey, r_name""",
    "list_entry": "select * from (values\n  " + _values(LIST_ENTRY_ROWS) + "\n) as t(list_type, identifier_type, "
                  "identifier_value, target_category, recommended_action, priority, is_active)",
    "rule": "select version, feature, key_value, target_category, recommended_action, cast(priority as int) as priority, "
            "is_active, cast(support as int) as support, cast(precision_cat_pct as int) as precision_cat_pct from (values\n  "
            + _values(RULE_ROWS) + "\n) as t(version, feature, key_value, target_category, recommended_action, priority, "
            "is_active, support, precision_cat_pct)",
    "snapshot": "select version, is_active, cast(created_at as timestamp) as created_at, cast(expires_at as timestamp) "
                "as expires_at, cast(invalidated_at as timestamp) as invalidated_at, cast(rules_count as int) as rules_count "
                "from (values\n  " + _values(SNAPSHOT_ROWS) + "\n) as t(version, is_active, created_at, expires_at, "
                "invalidated_at, rules_count)",
}

def with_fixtures(body_sql: str, uses: str | tuple | list) -> str:
    """Prefix an oracle query with the fixture CTEs it names."""
    names = uses.split() if isinstance(uses, str) else list(uses)
    ctes = ",\n".join(f"{n} as (\n{SQL[n]}\n)" for n in names)
    stripped = body_sql.lstrip()
    if not ctes:
        return stripped
    if stripped[:5].lower() == "with ":
        return f"with {ctes},\n{stripped[5:]}"
    return f"with {ctes}\n{stripped}"
