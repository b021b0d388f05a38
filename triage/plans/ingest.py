"""Nested payload sources and folder reports.

The service payloads are JSON documents. Here they are derived from the fixture tables with
``to_json`` (so their volume follows the data), then read back the way a job reads landed
JSON: ``from_json`` with an explicit schema, ``explode``/``inline``, projections. Each payload
is one small document (a top folder, a notification batch, a body response, a page batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triage.plans.work import candidate_page, split_batches
from triage.registry import register

c = F.col

# --- A10 / K22: folder tree --------------------------------------------------------

FOLDER = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("displayName", T.StringType()),
    T.StructField("totalItemCount", T.LongType()), T.StructField("unreadItemCount", T.LongType()),
    T.StructField("childFolderCount", T.LongType())])
FOLDER_PAGE = T.StructType([T.StructField("value", T.ArrayType(
    T.StructType(FOLDER.fields + [T.StructField("childFolders", T.ArrayType(FOLDER))])))])
# names whose folders are flagged as important (a parameter; these match the fixture folders)
IMPORTANT_FOLDERS = ("Europe", "Asia", "Ind", "SA")


def folder_payloads(folder: DataFrame) -> DataFrame:
    """One service page per top folder with its children expanded (two levels)."""
    kids = (folder.filter(c("level") == 1).groupBy(c("parent_folder_id").alias("pid"))
            .agg(F.collect_list(F.struct(c("folder_id").alias("id"), c("display_name").alias("displayName"),
                                         c("total_item_count").alias("totalItemCount"),
                                         (c("total_item_count") % 7).alias("unreadItemCount"),
                                         F.lit(0).cast("bigint").alias("childFolderCount"))).alias("kids")))
    roots = folder.filter(c("level") == 0).join(kids, c("folder_id") == c("pid"), "left")
    top = F.struct(c("folder_id").alias("id"), c("display_name").alias("displayName"),
                   c("total_item_count").alias("totalItemCount"), F.lit(0).cast("bigint").alias("unreadItemCount"),
                   F.size(F.coalesce("kids", F.array())).cast("bigint").alias("childFolderCount"),
                   c("kids").alias("childFolders"))
    return roots.select(F.to_json(F.struct(F.array(top).alias("value"))).alias("payload"))


def flatten_folders(payloads: DataFrame) -> DataFrame:
    top = payloads.select(F.explode(F.from_json("payload", FOLDER_PAGE)["value"]).alias("f"))
    roots = top.select(c("f.id").alias("folder_id"), c("f.displayName").alias("display_name"),
                       F.lit(None).cast("string").alias("parent_folder_id"), c("f.displayName").alias("folder_path"),
                       F.coalesce("f.totalItemCount", F.lit(0)).alias("total_item_count"),
                       F.coalesce("f.unreadItemCount", F.lit(0)).alias("unread_item_count"),
                       F.coalesce("f.childFolderCount", F.lit(0)).alias("child_folder_count"), F.lit(0).alias("level"))
    kids = top.select("f", F.explode_outer("f.childFolders").alias("k")).filter(c("k").isNotNull()).select(
        c("k.id").alias("folder_id"), c("k.displayName").alias("display_name"), c("f.id").alias("parent_folder_id"),
        F.concat(c("f.displayName"), F.lit("/"), c("k.displayName")).alias("folder_path"),
        F.coalesce("k.totalItemCount", F.lit(0)).alias("total_item_count"),
        F.coalesce("k.unreadItemCount", F.lit(0)).alias("unread_item_count"),
        F.coalesce("k.childFolderCount", F.lit(0)).alias("child_folder_count"), F.lit(1).alias("level"))
    flat = roots.unionByName(kids)
    important = F.lit(False)
    for name in IMPORTANT_FOLDERS:
        important = important | F.lower("display_name").contains(name.lower())
    return flat.withColumn("is_important", important)


SQL_FLAT = """flat as (
  select folder_id, display_name, parent_folder_id, folder_path, total_item_count,
    case when level = 1 then total_item_count % 7 else 0 end as unread_item_count,
    case when level = 0 then (select count(*) from folder k where k.parent_folder_id = f.folder_id) else 0 end
      as child_folder_count, level,
    """ + " or ".join(f"contains(lower(display_name), '{n.lower()}')" for n in IMPORTANT_FOLDERS) + """ as is_important
  from folder f)"""


@register("folder_flatten", ops="A10 K22 C12 B9 A5", uses="folder", sql="with " + SQL_FLAT + " select * from flat")
def folder_flatten(fx) -> DataFrame:
    return flatten_folders(folder_payloads(fx.folder))


@register("folder_totals", ops="I30 D16 D1", uses="folder", sql="with " + SQL_FLAT + """
select count(*) as total_folders, count(*) filter (where level = 0) as main_folders,
  count(*) filter (where level = 1) as sub_folders, cast(sum(total_item_count) as bigint) as total_messages,
  count(*) filter (where is_important) as important_folders from flat""")
def folder_totals(fx) -> DataFrame:
    f = flatten_folders(folder_payloads(fx.folder))
    return f.agg(F.count(F.lit(1)).alias("total_folders"), F.count_if(c("level") == 0).alias("main_folders"),
                 F.count_if(c("level") == 1).alias("sub_folders"),
                 F.sum("total_item_count").cast("bigint").alias("total_messages"),
                 F.count_if("is_important").alias("important_folders"))


@register("folder_top10", ops="F8 F4", uses="folder", sql="with " + SQL_FLAT + """
select display_name as name, folder_path as path, total_item_count as count, folder_id as id from flat
order by total_item_count desc, folder_id limit 10""")
def folder_top10(fx) -> DataFrame:
    f = flatten_folders(folder_payloads(fx.folder))
    return (f.orderBy(c("total_item_count").desc(), "folder_id").limit(10)
            .select(c("display_name").alias("name"), c("folder_path").alias("path"),
                    c("total_item_count").alias("count"), c("folder_id").alias("id")))


# --- A11 / J1 / J2: change notifications ---------------------------------------------

NOTIFICATION = T.StructType([T.StructField("value", T.ArrayType(T.StructType([
    T.StructField("changeType", T.StringType()), T.StructField("clientState", T.StringType()),
    T.StructField("resourceData", T.StructType([T.StructField("id", T.StringType())]))])))])


def notification_rows(notification: DataFrame, client_state: str | None = "ok") -> DataFrame:
    rows = notification.select("event_id", F.inline(F.from_json("payload", NOTIFICATION)["value"])).select(
        "event_id", "changeType", "clientState", c("resourceData.id").alias("message_id"))
    return rows if client_state is None else rows.filter(c("clientState") == client_state)


SQL_NOTIF = """nrows as (
  select n.event_id, v.changeType as changeType, v.clientState as clientState, v.resourceData.id as message_id
  from notification n, unnest(from_json(n.payload, '{"value":[{"changeType":"VARCHAR","clientState":"VARCHAR",
    "resourceData":{"id":"VARCHAR"}}]}').value) as t(v))"""


@register("notifications", ops="A11 J1 C12", uses="notification", sql="with " + SQL_NOTIF + """
select * from nrows where clientState = 'ok'""")
def notifications(fx) -> DataFrame:
    return notification_rows(fx.notification)


@register("notification_ids", ops="J2 D15 D5 (batch twin)", uses="notification", sql="with " + SQL_NOTIF + """
select message_id, bool_or(changeType = 'created') as any_created, count(*) as notifications
from nrows where clientState = 'ok' group by message_id""")
def notification_ids(fx) -> DataFrame:
    """Once-only view of repeated notifications: one row per message (streaming twin: J2)."""
    return notification_rows(fx.notification).groupBy("message_id").agg(
        F.bool_or(c("changeType") == "created").alias("any_created"), F.count(F.lit(1)).alias("notifications"))


# --- A12: body responses -----------------------------------------------------------

def body_responses(body: DataFrame) -> DataFrame:
    """Service-shaped responses: body, uniqueBody only, or content split into an array."""
    k = F.abs(F.hash("message_id")) % 3
    as_body = F.struct(F.struct(c("content_type").alias("contentType"), c("content").alias("content")).alias("body"))
    as_unique = F.struct(F.struct(c("content_type").alias("contentType"), c("content").alias("content"))
                         .alias("uniqueBody"))
    as_array = F.struct(F.struct(c("content_type").alias("contentType"),
                                 F.split("content", "\n").alias("content")).alias("body"))
    return body.select("message_id", F.when(k == 0, F.to_json(as_body)).when(k == 1, F.to_json(as_unique))
                       .otherwise(F.to_json(as_array)).alias("payload"))


def _part(name: str, content_type) -> T.StructType:
    return T.StructType([T.StructField(name, T.StructType([T.StructField("contentType", T.StringType()),
                                                           T.StructField("content", content_type)]))])


def parse_body_response(resp: DataFrame) -> DataFrame:
    """``body`` else ``uniqueBody``; arrays joined with newlines, objects serialised."""
    s_schema = T.StructType(_part("body", T.StringType()).fields + _part("uniqueBody", T.StringType()).fields)
    a_schema = T.StructType(_part("body", T.ArrayType(T.StringType())).fields
                            + _part("uniqueBody", T.ArrayType(T.StringType())).fields)
    s, a = F.from_json("payload", s_schema), F.from_json("payload", a_schema)
    b_arr, u_arr = a["body"]["content"], a["uniqueBody"]["content"]
    b_str = F.when(b_arr.isNull(), s["body"]["content"])
    u_str = F.when(u_arr.isNull(), s["uniqueBody"]["content"])
    content = F.coalesce(b_str, u_str, F.array_join(b_arr, "\n"), F.array_join(u_arr, "\n"))
    ctype = F.coalesce(s["body"]["contentType"], s["uniqueBody"]["contentType"])
    return resp.select("message_id", content.alias("content"), ctype.alias("content_type"),
                       F.coalesce(F.length(content) > 0, F.lit(False)).alias("has_content"))


@register("body_responses", ops="A12 B16 2.H", uses="body")
def body_responses_query(fx) -> DataFrame:
    """Round trip: the parsed responses must reproduce the body table (checked in tests)."""
    return parse_body_response(body_responses(fx.body))


# --- A13 / A9 / A17: batch items, id lists, point lookups ----------------------------

ITEMS = T.StructType([T.StructField("user_upn", T.StringType()), T.StructField("batch_number", T.IntegerType()),
                      T.StructField("batch_items", T.ArrayType(T.StructType([
                          T.StructField("message_id", T.StringType()), T.StructField("subject", T.StringType()),
                          T.StructField("from_domain", T.StringType())])))])


def batch_documents(fx, n_batches: int = 4) -> DataFrame:
    page = split_batches(candidate_page(fx), n_batches, [c("received_datetime").desc(), c("message_id")])
    return page.groupBy("user_upn", "batch_number").agg(
        F.to_json(F.struct("user_upn", "batch_number", F.sort_array(F.collect_list(
            F.struct("message_id", "subject", "from_domain"))).alias("batch_items"))).alias("doc"))


@register("batch_items", ops="A13 K12 C12", uses="mail body", sql="""
with page as (
  select * from mail where analyzed_at is null and coalesce(is_deleted, false) = false
    and coalesce(auto_processed, false) = false
  order by received_datetime desc, message_id limit 500),
n as (select *, row_number() over (order by received_datetime desc, message_id) - 1 as i, count(*) over () as cnt
      from page)
select user_upn, cast(least(i // (cnt // least(4, cnt)), least(4, cnt) - 1) + 1 as int) as batch_number,
  message_id, subject, from_domain from n""")
def batch_items(fx) -> DataFrame:
    """Flatten ``{user, batch_items[]}`` documents back to one row per item."""
    docs = batch_documents(fx)
    p = docs.select(F.from_json("doc", ITEMS).alias("d"))
    return p.select(c("d.user_upn").alias("user_upn"), c("d.batch_number").alias("batch_number"),
                    F.explode("d.batch_items").alias("it")).select("user_upn", "batch_number", "it.*")


def id_list_documents(fx, per_doc: int = 500, rows_per_salt: int = 1000) -> DataFrame:
    """Ids of messages that need a body, as JSON arrays of at most ``per_doc`` ids.

    Documents are cut inside (user, salt) groups, so no list grows with a hot mailbox.
    """
    from pyspark.sql import Window
    from triage.plans.work import salted
    todo = fx.mail.filter(c("analyzed_at").isNull() & ~F.coalesce(c("is_deleted"), F.lit(False))
                          & ~F.coalesce(c("auto_processed"), F.lit(False)) & c("needs_body")
                          & c("message_id").isNotNull())
    todo = salted(todo.select("user_upn", "message_id"), "user_upn", "message_id", rows_per_salt)
    i = F.row_number().over(Window.partitionBy("user_upn", "salt").orderBy("message_id")) - 1
    return (todo.withColumn("doc", (i / per_doc).cast("int")).groupBy("user_upn", "salt", "doc")
            .agg(F.to_json(F.collect_list("message_id")).alias("ids")))


@register("bodies_by_id_list", ops="A9 K13 C12", uses="mail body", sql="""
select b.message_id, b.content_type as body_content_type, cast(length(b.content) as int) as body_size_bytes
from body b where b.message_id in (
  select message_id from mail where analyzed_at is null and coalesce(is_deleted, false) = false
    and coalesce(auto_processed, false) = false and needs_body and message_id is not null)""")
def bodies_by_id_list(fx) -> DataFrame:
    """Read bodies for the ids carried in JSON array documents."""
    wanted = (id_list_documents(fx).select(F.explode(F.from_json("ids", T.ArrayType(T.StringType())))
                                           .alias("message_id")).distinct())
    b = fx.body.select("message_id", c("content_type").alias("body_content_type"),
                       F.length("content").cast("int").alias("body_size_bytes"))
    return b.join(wanted, "message_id", "left_semi")


@register("mail_lookup", ops="A17 C4 B7", uses="mail desired_state", sql="""
select e.message_id, e.from_address, e.from_domain, e.subject, e.user_upn from mail e
where e.is_deleted = false and e.message_id in (
  select message_id from desired_state where synced_at is null or sync_status is distinct from 'synced')""")
def mail_lookup(fx) -> DataFrame:
    """Point lookups made set-based: live mail rows for every wanted key (semi join)."""
    wanted = fx.desired_state.filter(c("synced_at").isNull() | ~c("sync_status").eqNullSafe(F.lit("synced")))
    return (fx.mail.filter(c("is_deleted") == F.lit(False)).join(wanted.select("message_id"), "message_id", "left_semi")
            .select("message_id", "from_address", "from_domain", "subject", "user_upn"))
