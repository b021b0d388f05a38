"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.llm import (collocations, decontam, fill_middle, html_extract, licenses, pieces, pii, quality, quality_rules,
                        secret_scan, url_filter)
from triage.llm.common import table
from triage.llm.jaccard import jaccard_join
from triage.llm.suffix_dedup import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), size=4, num=85, den=100)


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = remove_repeats(table(spark, sf_dir, "documents"), min_len=200, keep="none")
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def fifth() -> Column:
    """crc32 of the id as text, modulo 5: 0 is held out of training."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, "quality", where=fifth() != 0)
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(fifth() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def _spans(found: DataFrame, kinds) -> DataFrame:
    """Counts and digests of a span scan."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long) as n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(secret_scan.scan(table(spark, sf_dir, "documents")), secret_scan.KINDS)


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(pii.scan(table(spark, sf_dir, "documents")), pii.KINDS)


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _op5_sql() -> str:
    grid = [(r, v, c) for r, (v, cs) in quality_rules.RULES.items() for c in cs]
    values = ", ".join(f"({r!r}, {c})" for r, _, c in grid)
    measure = " ".join(f"when {r!r} then {v.split(' / ')[0]}::double / nullif({v.split(' / ')[1]}, 0)" for r, (v, _) in quality_rules.RULES.items())
    each, alpha = quality_rules.RISK / len(quality_rules.RULES), quality_rules.ALPHA
    return rf"""
with d as (
  select doc_id, coalesce(lang, '') stratum, coalesce(text, '') t,
         [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] w,
         [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] ls
  from documents),
win as (select doc_id, p, array_to_string(w[p:p + 7], ' ') x from (select doc_id, w, unnest(range(1, len(w) - 6)) p from d)),
rep as (select doc_id, p from win qualify count(*) over (partition by doc_id, x) > 1),
cov as (select doc_id, count(distinct q) n from (select doc_id, unnest(range(p, p + 8)) q from rep) group by 1),
m as (
  select d.doc_id, stratum, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, len(ls)::bigint n_lines,
         (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines, coalesce(cov.n, 0)::bigint n_repeat_words
  from d left join cov on cov.doc_id = d.doc_id),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed from m),
grid(rule, cutoff) as (values {values}),
v as (select doc_id, stratum, base_failed, rule, case rule {measure} end val from b, (select distinct rule from grid) r),
good as (select doc_id from labels where quality is not null group by 1 having min(quality) = 1),
counts as (
  select v.stratum, g.rule, g.cutoff, count(*) n, count(*) filter (v.val > g.cutoff) k
  from v join good using (doc_id) join grid g on g.rule = v.rule where not base_failed group by all),
tests as (select count(*) t from counts),
terms as (
  select stratum, rule, cutoff, unnest(range(0, k + 1)) i, n from counts where k < {each!r} * n),
sure as (
  select stratum, rule, cutoff from (
    select stratum, rule, cutoff, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({each!r}) + (n - i) * ln(1 - {each!r}))) p
    from terms group by all) where p <= {alpha!r} / (select t from tests)),
best as (select stratum, rule, min(cutoff) cutoff from sure group by all),
bad as (select distinct doc_id from v join best using (stratum, rule) where val > cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and doc_id not in (select doc_id from bad) kept
from b"""


SQL["op5_quality_rules"] = _op5_sql()


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# every window that starts at a shingle of an item of its size, or is the text's last, compared exactly; no fingerprints
SQL["op1_decontamination"] = r"""
with d as (select doc_id, [x for x in regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') if x <> ''] w from documents),
b as (select item_id, [x for x in regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') if x <> ''] w from benchmark),
ds as (select doc_id, greatest(len(w) - 4, 1) m, unnest(range(0, greatest(len(w) - 4, 1))) i, w from d where len(w) > 0),
dg as (select doc_id, m, i, array_to_string(w[i + 1:i + 5], ' ') x from ds),
bs as (select item_id, greatest(len(w) - 4, 1) k, unnest(range(0, greatest(len(w) - 4, 1))) p, w from b where len(w) > 0),
bg as (select item_id, k, p, array_to_string(w[p + 1:p + 5], ' ') x from bs),
al as (select distinct doc_id, k, m, least(i, greatest(m - k, 0)) s from dg join (select distinct k, x from bg) using (x)),
win0 as (select al.doc_id, al.k, al.m, s, x, count(*) n from al join dg on dg.doc_id = al.doc_id and dg.i >= s and dg.i < s + al.k group by all),
win as (select win0.*, item_id from win0 join (select distinct item_id, k, x from bg) using (k, x)),
item as (select item_id, x, count(*) n from bg group by all),
sim as (
  select win.doc_id, win.item_id, s, least(any_value(k), any_value(m)) + any_value(k) total, sum(least(win.n, item.n)) "both"
  from win join item on item.item_id = win.item_id and item.x = win.x group by all),
ok as (select doc_id, item_id, s, "both" / (total - "both") similarity from sim where "both" * 100 >= (total - "both") * 80)
select doc_id, item_id, min(s)::bigint first_word, any_value(similarity) similarity
from ok o where similarity = (select max(similarity) from ok i where i.doc_id = o.doc_id and i.item_id = o.item_id)
group by doc_id, item_id"""


def _doc_path() -> Column:
    """A layout for documents: source, language, a folder of 1000 ids, a file."""
    return F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("und")),
                       F.floor(F.col("doc_id") / 1000).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document that opens with a licence line is taken as its folder's licence file."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", _doc_path().alias("path"))
    return licenses.scan(docs, speaks=F.col("_first") == 0).select("doc_id", "path", "license", "origin", "score", "from_dir")


def _op2_sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quote(n)}, {quote(x)})" for i, (n, x) in enumerate(licenses.TEMPLATES))
    words = lambda c: f"[x for x in regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+') if x <> '']"
    sentence = f"regexp_split_to_array(txt, '{licenses.SENTENCE}')"
    own_marks = lambda c, vs: f"array_to_string(list_sort(list_intersect(list_distinct({c}), {list(vs)})), ' ')"
    of_t = ", ".join(f"case when regexp_matches(license, '{names}') then {own_marks(words('txt'), vs)} end {f}_t" for f, names, vs in licenses.VARIANTS)
    of_u = ", ".join(f"{own_marks(words('line'), vs)} {f}" for f, _, vs in licenses.VARIANTS)
    agree = " and ".join(f"({f}_t is null or {f}_t = {f})" for f, *_ in licenses.VARIANTS)
    return f"""
with t0(t, license, txt) as (values {values}),
t as (select *, {of_t} from t0),
tw as (select t, license, unnest({words('txt')}) term from t),
voc as (select distinct term from tw),
d as (select doc_id, coalesce(source, 'unknown') || '/' || coalesce(lang, 'und') || '/' || (doc_id // 1000)::varchar dir, coalesce(text, '') txt from documents),
df as (select term, count(*) df from (select unnest(list_distinct({words('txt')})) term from d) where term in (select term from voc) group by 1),
n as (select count(*) n from d),
idf as (select term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 idf from voc left join df using (term) cross join n),
tv as (select t, license, term, w / sqrt(sum(w * w) over (partition by t)) w from (
  select t, license, term, count(*) * any_value(idf) w from tw join idf using (term) group by all)),
ln as (select doc_id, 'line' unit, unnest(string_split(txt, chr(10))) line, generate_subscripts(string_split(txt, chr(10)), 1) - 1 line_no from d
       union all select doc_id, 'sentence', unnest({sentence}), generate_subscripts({sentence}, 1) - 1 from d),
lm as (select doc_id, unit, line_no, {of_u} from ln),
lw as (select doc_id, unit, line_no, unnest({words('line')}) term from ln),
lv as (select doc_id, unit, line_no, term, idf, w / sqrt(sum(w * w) over (partition by doc_id, unit, line_no)) w from (
  select doc_id, unit, line_no, term, any_value(idf) idf, count(*) * coalesce(any_value(idf), ln((select n from n) + 1.0) + 1) w
  from lw left join idf using (term) group by all)),
sc as (select doc_id, unit, line_no, license, t, round(sum(lv.w * tv.w), 6) score from lv join tv using (term) group by all),
hit as (select sc.* from sc join t using (t) join lm using (doc_id, unit, line_no) where score >= {licenses.LEAST} and {agree}),
line as (select doc_id, line_no, license, score from hit qualify row_number() over (partition by doc_id, unit, line_no order by score desc, license) = 1),
own as (select doc_id, license, score, min(line_no) over (partition by doc_id) first from line
        qualify row_number() over (partition by doc_id order by score desc, line_no, license) = 1),
voice as (select dir, license, count(*) n from own join d using (doc_id) where first = 0 group by all),
heads as (select dir, license from voice qualify row_number() over (partition by dir order by n desc, license) = 1),
up as (select doc_id, unnest([dir, regexp_extract(dir, '^(.*)/[^/]*$', 1), regexp_extract(dir, '^([^/]*)/', 1), '']) anc, unnest([1, 2, 3, 4]) far from d),
near as (select doc_id, anc, license from up join heads on heads.dir = anc qualify row_number() over (partition by doc_id order by far) = 1)
select doc_id, dir || '/' || doc_id::varchar || '.txt' path, coalesce(own.license, near.license) license,
       case when own.license is not null then 'own' when near.license is not null then 'inherited' else 'none' end origin,
       own.score score, case when own.license is null then near.anc end from_dir
from d left join own using (doc_id) left join near using (doc_id)"""


SQL["op2_license_scan"] = _op2_sql()


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pieces.encoded(table(spark, sf_dir, "documents"), dropout=0.1, seed=1)
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time from their number: one every 97 minutes over a year, round and round."""
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.col("page_id") * 97 * 60, F.lit(365 * 86400)))
    return pages.select("page_id", "url", at.alias("fetched"))


def list_log(pages: DataFrame) -> DataFrame:
    """A dated list from the hosts in ``pages``: each host enters, changes or leaves by its letters.

    Hosts whose length is a multiple of 3 are blocked on day 30 + 7 * (length mod 20), removed
    100 days later and blocked again 60 days after that; of a length 1 above that their first
    language folder is blocked from day 60 on, and the host's parent domain allowed from day 90 on.
    """
    h = pages.select(url_filter.host_of(F.col("url")).alias("host"), F.regexp_extract("url", "^[^/]*//[^/]*/([^/?#]+)/", 1).alias("folder")) \
        .filter("host is not null").distinct()
    n = F.length("host")
    day = lambda d: F.timestamp_seconds(F.lit(1_704_067_200) + d * 86400)
    entry = lambda key, action, d: F.struct(key.alias("key"), F.lit(action).alias("action"), day(d).alias("since"))
    start = 30 + 7 * (n % 20)
    log = F.when(n % 3 == 0, F.array(entry(F.col("host"), "block", start), entry(F.col("host"), "remove", start + 100),
                                     entry(F.col("host"), "block", start + 160))) \
        .when((n % 3 == 1) & (F.col("folder") != ""), F.array(
            entry(F.concat("host", F.lit("/"), "folder", F.lit("/")), "block", F.lit(60)),
            entry(F.regexp_replace("host", "^[^.]*[.]", ""), "allow", F.lit(90))))
    return h.select(F.explode(log).alias("e")).select("e.*").distinct()


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(captures(pages), list_log(pages)).select(
        "page_id", "host", F.unix_timestamp("fetched").alias("fetched_s"), "verdict", "key", F.unix_timestamp("since").alias("since_s"))


SQL["op10_url_filter"] = r"""
with p as (select page_id, url, timestamp '2024-01-01 00:00:00' + to_seconds((page_id * 97 * 60) % (365 * 86400)) fetched from pages),
u as (select *, nullif(regexp_replace(regexp_replace(lower(regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', ''), '^www\.', ''), '') host,
      regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1) path,
      regexp_extract(url, '^[^/]*//[^/]*/([^/?#]+)/', 1) folder from p),
h as (select distinct host, folder, length(host) n from u where host is not null),
log as (
  select host key, 'block' action, 30 + 7 * (n % 20) d from h where n % 3 = 0
  union select host, 'remove', 130 + 7 * (n % 20) from h where n % 3 = 0
  union select host, 'block', 190 + 7 * (n % 20) from h where n % 3 = 0
  union select host || '/' || folder || '/', 'block', 60 from h where n % 3 = 1 and folder <> ''
  union select regexp_replace(host, '^[^.]*[.]', ''), 'allow', 90 from h where n % 3 = 1 and folder <> ''),
e as (select key, min(action) action, timestamp '2024-01-01 00:00:00' + to_days(d::int) since from log group by key, d),
latest as (
  select page_id, fetched, e.key, arg_max(action, since) action, max(since) since,
         case when contains(e.key, '/') then 100 + length(e.key) else length(e.key) end depth
  from u join e on since <= fetched and (host = e.key or ends_with(host, '.' || e.key) or starts_with(host || path, e.key) and contains(e.key, '/'))
  group by all),
best as (select * from latest where action <> 'remove' qualify row_number() over (partition by page_id order by depth desc) = 1)
select u.page_id, host, epoch(u.fetched)::bigint fetched_s, coalesce(action, 'none') verdict, key, epoch(since)::bigint since_s from u left join best using (page_id)"""


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), longest=4, least=30, covered=80, best=2000)


SQL["op11_phrase_collocations"] = r"""
with d as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) piece from d),
w as (select lang, [x for x in regexp_split_to_array(piece, '[ \t]+') if x <> ''] w from p),
g as (select lang, k, unnest([w[i:i + k - 1] for i in range(1, len(w) - k + 2)]) g from w, (values (1), (2), (3), (4)) ks(k) where len(w) >= k),
f as (select lang, k, g, count(*) f from g group by all),
n as (select lang, sum(f)::bigint n from f where k = 1 group by lang),
c as (select * from f where k > 1 and f >= 30),
cuts as (select lang, k, g, f a, unnest(range(1, k)) cut from c),
sc as (
  select cuts.lang, cuts.k, cuts.g, cuts.a, cut, x.f l, y.f r, (2000000::hugeint * cuts.a::hugeint // (x.f::hugeint + y.f::hugeint))::bigint score
  from cuts join f x on x.lang = cuts.lang and x.g = cuts.g[1:cut] join f y on y.lang = cuts.lang and y.g = cuts.g[cut + 1:cuts.k]),
low as (select * from sc qualify row_number() over (partition by lang, g order by score, cut) = 1),
inner_ as (
  select lang, f, unnest(flatten([[g[i:i + s - 1] for i in range(1, k - s + 2)] for s in range(2, k)])) g from c where k > 2),
longer as (select lang, g, max(f) f from inner_ group by all),
kept as (
  select low.*, array_to_string(low.g, ' ') phrase from low left join longer on longer.lang = low.lang and longer.g = low.g
  where longer.f is null or 100 * longer.f::hugeint < 80 * low.a::hugeint),
best as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) "rank" from kept)
select best.lang, "rank", phrase, a, l, r, n, score from best join n on n.lang = best.lang where "rank" <= 2000"""


@query
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages)).select("page_id", "url", "text", "n_chars")


@query
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fill_middle.transform(table(spark, sf_dir, "documents"), unit="char", seed=1)
    return got.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL["op13_fill_middle"] = """
with d as (select doc_id, coalesce(text, '') t, length(coalesce(text, '')) n, sha256('1:' || coalesce(doc_id::varchar, '')) h from documents),
h as (select *, ('0x' || h[1:8])::bigint h1, ('0x' || h[9:16])::bigint h2, ('0x' || h[17:24])::bigint h3, ('0x' || h[25:32])::bigint h4 from d),
c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) i, greatest(h1 % (n + 1), h2 % (n + 1)) j,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end form from h)
select doc_id, n::bigint n, form, case when form <> 'plain' then i::bigint end prefix_chars, case when form <> 'plain' then (j - i)::bigint end middle_chars,
       sha256(case form when 'plain' then t
              when 'psm' then '<P>' || substring(t, 1, i) || '<S>' || substring(t, j + 1) || '<M>' || substring(t, i + 1, j - i)
              else '<S>' || substring(t, j + 1) || '<P>' || substring(t, 1, i) || '<M>' || substring(t, i + 1, j - i) end) output_sha256,
       sha256(t) restored_sha256
from c"""
