"""Body cleaning as Column expressions (K9, K10, K31; 4.4 of the survey).

Every step is a regex or array expression evaluated per row inside whole-stage codegen; no
Python UDF. ``sql_*`` builds the same pipeline as DuckDB SQL for the oracles.

Semantics kept on purpose: tags are stripped before ``<http..>`` links are unwrapped (T30);
named entities are decoded before numeric ones, so ``&amp;#39;`` becomes ``'`` (T31); ``&amp;``
is decoded last among the named entities, which equals a single left-to-right pass;
truncation prefers a paragraph break beyond 60 % of the limit, then a sentence end, else a
hard cut (T32). Lengths are code points (JavaScript counts UTF-16 units; equal outside
astral characters).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BODY_CHARS = 12000

# fixed values: white space removed by JavaScript trim(), and zero-width characters removed
JS_SPACE = r"[\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
JS_SPACE_CHARS = ("\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
                  + "\u2028\u2029\u202f\u205f\u3000\ufeff")
ZERO_WIDTH = r"[\x{034F}\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}]"
# fixed values: named entities and their characters; '&amp;' must stay last
NAMED_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
                  ("&apos;", "'"), ("&amp;", "&"))
# fixed value: host of wrapped ("safe") links whose url/target parameter holds the real link
SAFELINK_HOST = r"(?i)safelinks\.protection\.outlook\.com"
URL_IN_TEXT = r"(?i)\bhttps?://[^\s)>\]]+"
WORD_SPLIT = r"[ \t\n\f\r]+"


def js_trim(col: Column) -> Column:
    """JavaScript's trim(). Looks at both ends only; the pattern, which tries every position of the text,
    is left for texts that end in NEL, a line end to ``$`` and not white space to trim(). ``col`` is named
    twice: it should be a column, not a chain of expressions."""
    return (F.when(F.endswith(col, F.lit("\u0085")), F.regexp_replace(col, f"^{JS_SPACE}+|{JS_SPACE}+$", ""))
            .otherwise(F.btrim(col, F.lit(JS_SPACE_CHARS))))


def replace_each(col: Column, pattern: str, decode) -> Column:
    """``col`` with every match of ``pattern`` (no groups) replaced by ``decode(match)``, in one pass:
    what a replacement yields is not looked at again."""
    between = F.split(col, pattern, -1)
    hits = F.transform(F.regexp_extract_all(col, F.lit(f"({pattern})"), 1), decode)
    return F.array_join(F.zip_with(between, F.concat(hits, F.array(F.lit(""))), lambda x, y: F.concat(x, y)), "")


def _from_units(units: Column) -> Column:
    """Text of an array of UTF-16 code units in 4 hex digits; unpaired surrogates become U+FFFD."""
    u = F.concat(F.array_join(units, ","), F.lit(","))
    u = F.regexp_replace(u, r"(?:D[89AB][0-9A-F]{2}),(?!D[C-F])", "FFFD,")
    u = F.regexp_replace(u, r"(?<!D[89AB][0-9A-F]{2},)D[C-F][0-9A-F]{2},", "FFFD,")
    return F.decode(F.unhex(F.replace(u, F.lit(","))), "UTF-16BE")


def _unit(n: Column) -> Column:
    """String.fromCharCode of decimal digits: a double modulo 65536; what is no number is 0."""
    m = F.pmod(n.cast("double"), F.lit(65536.0))
    return F.lpad(F.hex(F.when(F.isnan(m), 0).otherwise(m).cast("int")), 4, "0")


def decode_named(col: Column) -> Column:
    s = col
    for ent, ch in NAMED_ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return s


def decode_numeric(col: Column) -> Column:
    return replace_each(col, r"(?:&#\d+;)+", lambda run: _from_units(
        F.transform(F.regexp_extract_all(run, F.lit(r"&#(\d+);"), 1), _unit)))


def decode_hex(col: Column) -> Column:
    return replace_each(col, r"(?:&#x[0-9a-fA-F]+;)+", lambda run: _from_units(
        F.transform(F.regexp_extract_all(run, F.lit(r"&#x([0-9a-fA-F]+);"), 1),
                    lambda h: F.right(F.concat(F.lit("0000"), F.upper(h)), F.lit(4)))))


def decode_entities(col: Column) -> Column:
    """Named, then decimal, then hex entities (column form; ``clean_frame`` stages these)."""
    return decode_hex(decode_numeric(decode_named(col)))


def strip_tags(col: Column) -> Column:
    s = F.coalesce(col, F.lit(""))
    s = F.regexp_replace(s, r"(?i)<script[\s\S]*?>[\s\S]*?</script>", "")
    s = F.regexp_replace(s, r"(?i)<style[\s\S]*?>[\s\S]*?</style>", "")
    s = F.regexp_replace(s, r"(?i)</p>", "\n\n")
    s = F.regexp_replace(s, r"(?i)<br\s*/?>", "\n")
    return F.regexp_replace(s, r"</?[^>]+>", "")


def strip_html(col: Column) -> Column:
    return decode_entities(strip_tags(col))


def unwrap_links(col: Column) -> Column:
    return F.regexp_replace(col, r"(?i)<(https?://[^>]+)>", "$1")


def decode_safelinks(col: Column) -> Column:
    def orig(u):
        q = F.coalesce(F.try_parse_url(u, F.lit("QUERY"), F.lit("url")),
                       F.try_parse_url(u, F.lit("QUERY"), F.lit("target")))
        once = F.try_url_decode(q)                                          # searchParams.get
        twice = F.try_url_decode(F.replace(once, F.lit("+"), F.lit("%2B")))  # decodeURIComponent
        return F.coalesce(F.nullif(twice, F.lit("")), u)

    return replace_each(col, URL_IN_TEXT, lambda u: F.when(u.rlike(SAFELINK_HOST), orig(u)).otherwise(u))


def collapse_whitespace(col: Column) -> Column:
    t = F.replace(col, F.lit("\r\n"), F.lit("\n"))
    t = F.replace(t, F.lit("\t"), F.lit(" "))
    t = F.regexp_replace(t, r"[ \x{00A0}]+", " ")
    t = F.regexp_replace(t, r" *\n *", "\n")
    t = F.regexp_replace(t, ZERO_WIDTH, "")
    return F.regexp_replace(t, r"\n{3,}", "\n\n")


def normalize_whitespace(col: Column) -> Column:
    """Collapsed and trimmed (column form; ``clean_frame`` stages the two)."""
    return js_trim(collapse_whitespace(col))


STAGES = ("_plain", "_html", "_plain_ok", "_tags", "_named", "_dec", "_stripped", "_unwrapped", "_safe", "_collapsed", "_norm", "_n",
          "_rp", "_par", "_dot")


def clean_frame(df: DataFrame, content: str = "content", content_type: str = "content_type",
                limit: int | None = MAX_BODY_CHARS) -> DataFrame:
    """K9 over a DataFrame, in staged projections; ``limit`` None: the whole normalised text.

    Each expensive intermediate (stripped HTML, normalised text, its prefix and reversal) is
    a named column of its own projection. Catalyst does not inline a non-trivial expression
    that is consumed more than once, so every regex pass runs once per row instead of once
    per reference.
    """
    ct, raw = F.col(content_type), F.col(content)
    plain = F.when(ct == "text", raw)
    html = F.when(ct == "html", raw)
    s1 = df.select("*", plain.alias("_plain"), html.alias("_html"))
    s2 = s1.select("*", F.coalesce(F.length(js_trim(F.col("_plain"))) > 0, F.lit(False)).alias("_plain_ok"),
                   (F.when(F.col("_html").isNotNull(), strip_tags(F.col("_html")))).alias("_tags"))
    s3 = s2.select("*", decode_named(F.col("_tags")).alias("_named"))
    s4 = s3.select("*", decode_numeric(F.col("_named")).alias("_dec"))
    s5 = s4.select("*", decode_hex(F.col("_dec")).alias("_stripped"))
    base = F.when(F.col("_plain_ok"), F.col("_plain")).otherwise(F.coalesce(F.col("_stripped"), F.lit("")))
    label = (F.when(F.coalesce(F.col("_plain") != "", F.lit(False)), "text")
             .when(F.coalesce(F.col("_html") != "", F.lit(False)), "html→text").otherwise("none"))
    s6 = s5.select("*", unwrap_links(base).alias("_unwrapped"), label.alias("body_source"))
    s7 = s6.select("*", decode_safelinks(F.col("_unwrapped")).alias("_safe"))
    s8 = s7.select("*", collapse_whitespace(F.col("_safe")).alias("_collapsed"))
    s8 = s8.select("*", js_trim(F.col("_collapsed")).alias("_norm"))
    if limit is None:
        return s8.select("*", F.coalesce(F.length(raw), F.lit(0)).cast("int").alias("content_len"),
                         F.sha2(raw, 256).alias("content_hash"), F.col("_norm").alias("body_text"),
                         F.lit(False).alias("body_truncated")).drop(*STAGES)
    s9 = s8.select("*", F.length("_norm").alias("_n"), F.reverse(F.substring("_norm", 1, limit + 2)).alias("_rp"))
    s10 = s9.select("*", _last_index_rev(F.col("_rp"), "\n\n").alias("_par"),
                    _last_index_rev(F.col("_rp"), ". ").alias("_dot"))
    cut = limit * 0.6
    n, par, dot, norm = F.col("_n"), F.col("_par"), F.col("_dot"), F.col("_norm")
    body = (F.when(n <= limit, norm)
            .when(par > cut, js_trim(F.substring(norm, F.lit(1), par)))
            .when(dot > cut, js_trim(F.substring(norm, F.lit(1), dot + 1)))
            .otherwise(js_trim(F.substring(norm, 1, limit))))
    out = s10.select("*", F.coalesce(F.length(raw), F.lit(0)).cast("int").alias("content_len"),
                     F.sha2(raw, 256).alias("content_hash"), body.alias("body_text"), (n > limit).alias("body_truncated"))
    return out.drop(*STAGES)


def _last_index_rev(rev_prefix: Column, x: str) -> Column:
    """Last position of ``x``, from the reversed prefix (-1: none)."""
    pos = F.locate(x[::-1], rev_prefix)
    return F.when(pos > 0, F.length(rev_prefix) - pos - F.lit(len(x)) + 1).otherwise(F.lit(-1))


def body_hash(b: Column) -> Column:
    """SHA-256 of a cleaned body; an empty one has none."""
    return F.sha2(F.nullif(b, F.lit("")), 256)


def finish(df, limit: int = MAX_BODY_CHARS):
    b = F.col("body_text")
    return df.select("*", body_hash(b).alias("body_hash"), F.ceil(F.length(b) / 4).cast("int").alias("tokens_est"),
                     F.length(b).cast("int").alias("body_chars"), F.lit(limit).alias("max_body_chars"))


# --- DuckDB twin ---------------------------------------------------------------------

def sql_js_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{JS_SPACE}+|{JS_SPACE}+$', '', 'g')"


def sql_decode_entities(x: str) -> str:
    s = x
    for ent, ch in NAMED_ENTITIES:
        s = f"replace({s}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    s = _sql_replace_each(s, r"(?:&#\d+;)+", lambda r: _sql_units(
        f"[cast(cast(x as double) % 65536 as int) for x in regexp_extract_all({r}, '&#(\\d+);', 1)]"))
    return _sql_replace_each(s, "(?:&#x[0-9a-fA-F]+;)+", lambda r: _sql_units(
        f"[cast('0x' || right('0000' || x, 4) as int) for x in regexp_extract_all({r}, '&#x([0-9a-fA-F]+);', 1)]"))


def _sql_replace_each(x: str, pattern: str, decode) -> str:
    return (f"array_to_string(list_transform(list_zip(regexp_split_to_array({x}, '{pattern}'), "
            f"list_append(regexp_extract_all({x}, '{pattern}'), '')), lambda p: p[1] || case when p[2] = '' then '' else "
            f"{decode('p[2]')} end), '')")


def _sql_units(u: str) -> str:
    """Characters of a list of UTF-16 units, pair by pair (neighbours are zipped to each unit)."""
    return (f"array_to_string(list_transform(list_zip({u}, list_prepend(0, {u}), list_append(({u})[2:], 0)), lambda t: "
            "case when t[1] between 55296 and 56319 then case when t[3] between 56320 and 57343 "
            "then chr(65536 + (t[1] - 55296) * 1024 + t[3] - 56320) else chr(65533) end "
            "when t[1] between 56320 and 57343 then case when t[2] between 55296 and 56319 then '' else chr(65533) end "
            "when t[1] is null then '' else chr(t[1]) end), '')")


def sql_strip_html(x: str) -> str:
    s = f"coalesce({x}, '')"
    s = f"regexp_replace({s}, '<script[\\s\\S]*?>[\\s\\S]*?</script>', '', 'gi')"
    s = f"regexp_replace({s}, '<style[\\s\\S]*?>[\\s\\S]*?</style>', '', 'gi')"
    s = f"regexp_replace({s}, '</p>', chr(10) || chr(10), 'gi')"
    s = f"regexp_replace({s}, '<br\\s*/?>', chr(10), 'gi')"
    s = f"regexp_replace({s}, '</?[^>]+>', '', 'g')"
    return sql_decode_entities(s)


def sql_normalize(x: str) -> str:
    t = f"replace({x}, chr(13) || chr(10), chr(10))"
    t = f"replace({t}, chr(9), ' ')"
    t = f"regexp_replace({t}, '[ \\x{{00A0}}]+', ' ', 'g')"
    t = f"regexp_replace({t}, ' *\\n *', chr(10), 'g')"
    t = f"regexp_replace({t}, '{ZERO_WIDTH}', '', 'g')"
    t = f"regexp_replace({t}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return sql_js_trim(t)


def sql_decode_links(x: str) -> str:
    url = r"(?i)\bhttps?://[^\s)>\]]+"
    real = ("url_decode(url_decode(coalesce(nullif(regexp_extract(p[2], '[?&]url=([^&#]*)', 1), ''), "
            "nullif(regexp_extract(p[2], '[?&]target=([^&#]*)', 1), ''))))")
    return (f"array_to_string(list_transform(list_zip(regexp_split_to_array({x}, '{url}'), "
            f"list_append(regexp_extract_all({x}, '{url}'), '')), lambda p: p[1] || case when regexp_matches(p[2], "
            f"'{SAFELINK_HOST}') then coalesce({real}, p[2]) else p[2] end), '')")


def sql_clean_ctes(src: str, limit: int | None = MAX_BODY_CHARS) -> str:
    """CTE chain over ``src`` (message_id, content, content_type) ending in ``finished``."""
    if limit is None:
        limit = 1 << 31  # nothing is that long: the whole text
    cut = limit * 0.6
    return f"""picked as (
  select *, case when content_type = 'text' then content end as plain,
    case when content_type = 'html' then content end as html from {src}),
based as (
  select *, case when coalesce(length({sql_js_trim('plain')}) > 0, false) then plain else {sql_strip_html('html')} end as base,
    case when coalesce(plain <> '', false) then 'text' when coalesce(html <> '', false) then 'html→text' else 'none' end
      as body_source
  from picked),
unwrapped as (select *, regexp_replace(base, '<(https?://[^>]+)>', '\\1', 'gi') as unw from based),
linked as (select *, {sql_decode_links('unw')} as lnk from unwrapped),
normed as (select *, {sql_normalize('lnk')} as norm from linked),
idx as (
  select *, substring(norm, 1, {limit + 2}) as p2 from normed),
idx2 as (
  select *, case when strpos(reverse(p2), chr(10) || chr(10)) > 0
      then length(p2) - strpos(reverse(p2), chr(10) || chr(10)) - 2 + 1 else -1 end as par,
    case when strpos(reverse(p2), ' .') > 0 then length(p2) - strpos(reverse(p2), ' .') - 2 + 1 else -1 end as dot
  from idx),
cleaned as (
  select message_id, cast(coalesce(length(content), 0) as int) as content_len, sha256(content) as content_hash,
    case when length(norm) <= {limit} then norm
         when par > {cut} then {sql_js_trim('substring(norm, 1, par)')}
         when dot > {cut} then {sql_js_trim('substring(norm, 1, dot + 1)')}
         else {sql_js_trim(f'substring(norm, 1, {limit})')} end as body_text,
    length(norm) > {limit} as body_truncated, body_source
  from idx2),
finished as (
  select *, sha256(nullif(body_text, '')) as body_hash, cast(ceil(length(body_text) / 4) as int) as tokens_est,
    cast(length(body_text) as int) as body_chars, {limit} as max_body_chars from cleaned)"""
