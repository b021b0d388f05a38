"""Body cleaning job and text facts over the body table.

All per-row work is column expressions (whole-stage codegen, no Python). The only shuffle is
the content-hash grouping of K32, which aggregates before joining back (AQE splits a hot hash).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.functions.text import (MAX_BODY_CHARS, WORD_SPLIT, body_hash, clean_frame, finish, js_trim, sql_clean_ctes,
                                   sql_js_trim)
from triage.registry import register
from triage.session import checkpoint_dir

c = F.col


def clean_bodies(body: DataFrame, limit: int = MAX_BODY_CHARS) -> DataFrame:
    out = clean_frame(body.select("message_id", "content", "content_type"), limit=limit)
    return finish(out.select("message_id", "content_len", "content_hash", "body_text", "body_truncated",
                             "body_source"), limit)


@register("clean_html", ops="K9 2.H T28-T32 B2", uses="body", sql="with src as (select * from body where content_type = 'html'),\n"
          + sql_clean_ctes("src") + "\nselect * from finished")
def clean_html(fx) -> DataFrame:
    return clean_bodies(fx.body.filter(c("content_type") == "html"))


@register("clean_plain", ops="K9 T32", uses="body", sql="with src as (select * from body where content_type = 'text'),\n"
          + sql_clean_ctes("src") + "\nselect * from finished")
def clean_plain(fx) -> DataFrame:
    return clean_bodies(fx.body.filter(c("content_type") == "text"))


@register("body_source", ops="K10 B15 T21 T28", uses="mail body", sql="""
select e.message_id,
  coalesce(nullif(b.content, ''), null) is not null as has_body,
  case when b.content is not null then 'html' end as body_content_type,
  cast(coalesce(length(b.content), 0) as int) as body_size_bytes,
  coalesce(length(b.content), 0) > 100 as body_over_100,
  case when coalesce(nullif(b.content, ''), null) is not null and e.analyzed_at is null then 'pre_ai_guard'
       when e.needs_body then 'fetch_body' else 'no_body' end as route
from mail e left join body b on b.message_id = e.message_id
where coalesce(e.is_deleted, false) = false""")
def body_source(fx) -> DataFrame:
    """Presence flags and the three-way route (the reference silently drops the third, T21)."""
    m = fx.mail.filter(~F.coalesce(c("is_deleted"), F.lit(False))).select("message_id", "analyzed_at", "needs_body")
    # lengths, not bodies, enter the join
    b = fx.body.select("message_id", F.length("content").alias("size"))
    size = F.coalesce("size", F.lit(0))
    has = size > 0
    return m.join(b, "message_id", "left").select(
        "message_id", has.alias("has_body"), F.when(c("size").isNotNull(), F.lit("html")).alias("body_content_type"),
        size.cast("int").alias("body_size_bytes"), (size > 100).alias("body_over_100"),
        F.when(has & c("analyzed_at").isNull(), "pre_ai_guard").when(c("needs_body"), "fetch_body")
        .otherwise("no_body").alias("route"))


LINK = r"(?i)href\s*=\s*[\"']?(https?://[^\"' >]+)"
IMG = r"(?i)<img\b"
SENTENCE = r"[.!?]+(\s|$)"


@register("text_metrics", ops="K31", uses="body", sql="with src as (select * from body),\n" + sql_clean_ctes("src", None) + f"""
select f.message_id,
  cast(len(list_filter(regexp_split_to_array(f.body_text, '{WORD_SPLIT}'), lambda x: x <> '')) as int) as word_count,
  cast(len(regexp_extract_all(f.body_text, '[.!?]+(\\s|$)')) as int) as sentence_count,
  cast(len(list_filter(regexp_split_to_array(f.body_text, '\\n\\n+'), lambda x: {sql_js_trim('x')} <> '')) as int)
    as paragraph_count,
  cast(len(regexp_extract_all(b.content, '(?i)href\\s*=\\s*["'']?(https?://[^"'' >]+)', 1)) as int) as link_count,
  cast(len(regexp_extract_all(b.content, '(?i)<img\\b')) as int) as image_count,
  array_to_string(list_distinct(regexp_extract_all(b.content, '(?i)href\\s*=\\s*["'']?(https?://[^"'' >]+)', 1))
    .list_sort(), ' ') as links_extracted
from finished f join body b on b.message_id = f.message_id""")
def text_metrics(fx) -> DataFrame:
    """Counts over the whole normalised text and the raw body, in one projection without a join."""
    d = clean_frame(fx.body.select("message_id", "content", "content_type"), limit=None).select(
        "message_id", "content", "body_text", F.regexp_extract_all(c("content"), F.lit(LINK), 1).alias("_links"))
    t, links = c("body_text"), c("_links")
    return d.select(
        "message_id",
        F.size(F.filter(F.split(t, WORD_SPLIT), lambda x: x != "")).cast("int").alias("word_count"),
        F.size(F.regexp_extract_all(t, F.lit(SENTENCE), 0)).cast("int").alias("sentence_count"),
        F.size(F.filter(F.split(t, r"\n\n+"), lambda x: js_trim(x) != "")).cast("int").alias("paragraph_count"),
        F.size(links).cast("int").alias("link_count"),
        F.size(F.regexp_extract_all(c("content"), F.lit(IMG), 0)).cast("int").alias("image_count"),
        F.array_join(F.array_sort(F.array_distinct(links)), " ").alias("links_extracted"))


@register("content_duplicates", ops="K32 D1 D9", uses="body", sql="with src as (select * from body),\n"
          + sql_clean_ctes("src", None) + """,
g as (select body_hash, min(message_id) as keep_id, count(*) as copies from finished where body_hash is not null
      group by body_hash)
select f.message_id, f.body_hash, g.keep_id as duplicate_of, cast(g.copies as bigint) as copies
from finished f join g on g.body_hash = f.body_hash
where g.copies > 1""")
def content_duplicates(fx) -> DataFrame:
    """Bodies whose whole cleaned text hashes equal; each points at the smallest id of its group.
    Empty bodies have no hash and no duplicates."""
    # the cleaned hashes are consumed twice (group, join back): cut lineage with a reliable
    # checkpoint in the shared folder instead of cleaning every body twice
    checkpoint_dir(fx.spark)
    f = clean_frame(fx.body.select("message_id", "content", "content_type"), limit=None).select(
        "message_id", body_hash(c("body_text")).alias("body_hash")).checkpoint(eager=True)
    f = f.filter("body_hash is not null")  # of what is read back: a filter below would clean every body again
    g = (f.groupBy("body_hash").agg(F.min("message_id").alias("duplicate_of"), F.count(F.lit(1)).alias("copies"))
         .filter(c("copies") > 1))
    return f.join(g, "body_hash").select("message_id", "body_hash", "duplicate_of", c("copies").cast("bigint"))
