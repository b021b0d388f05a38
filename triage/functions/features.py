"""Feature extraction as pure Column functions (K1 matcher flavour, K2 mining flavour).

The two flavours differ on purpose (T1-T5) and keep separate names:

* ``match_*``  the rule matcher: trims, strips display names, first regex match, null when a
  pattern does not match, lowercases header facts.
* ``mining_*`` the rule miner: a replace-whole-string regex that returns the input when it does
  not match (T1, T2), greedy so the *last* match wins (T3), no trim, header facts as is (T4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triage.functions.text import js_trim  # JavaScript trim(): Unicode white space

FEATURES = ("from_domain", "list_domain", "unsub_domain", "message_id_domain", "precedence",
            "auto_submitted", "from_address", "sender_address", "reply_to_address", "return_path")

def _first(col: Column, pattern: str) -> Column:
    """First regex capture, null when there is no match."""
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))


def _empty_to_null(col: Column) -> Column:
    return F.when(col.isNull() | (col == ""), F.lit(None).cast("string")).otherwise(col)


# --- matcher flavour (K1) -----------------------------------------------------

def match_address(col: Column) -> Column:
    a = F.lower(js_trim(col))
    a = F.coalesce(_first(a, "<([^>]+)>"), a)
    norm = F.when(F.instr(a, "@") > 0,
                  F.concat(F.split_part(F.split_part(a, F.lit("@"), F.lit(1)), F.lit("+"), F.lit(1)),
                           F.lit("@"), F.split_part(a, F.lit("@"), F.lit(2)))).otherwise(a)
    return F.when(col.isNull() | (col == ""), F.lit(None).cast("string")).otherwise(norm)


def match_domain_of(address: Column) -> Column:
    n = match_address(address)
    return F.when(F.instr(n, "@") > 0, F.split_part(n, F.lit("@"), F.lit(2)))


def match_from_domain(from_domain: Column, from_address: Column) -> Column:
    return F.coalesce(_empty_to_null(F.lower(from_domain)), match_domain_of(from_address))


def match_message_id_domain(col: Column) -> Column:
    return F.lower(_first(col, "@([^>]+)"))


def match_list_domain(col: Column) -> Column:
    return F.lower(_first(col, "<([^>]+)>"))


def match_unsub_domain(col: Column) -> Column:
    return F.lower(F.coalesce(_first(col, "https?://([^/>,;\\s]+)"),
                              _first(col, "mailto:.*@([^>,;\\s]+)"),
                              _first(col, "@([^>,;\\s]+)")))


def match_features(mail) -> list[Column]:
    """The matcher's feature columns, named as features, for a mail DataFrame (column form)."""
    c = F.col
    return [
        match_address(c("from_address")).alias("from_address"),
        match_address(c("sender_address")).alias("sender_address"),
        match_address(c("reply_to_address")).alias("reply_to_address"),
        match_from_domain(c("from_domain"), c("from_address")).alias("from_domain"),
        match_message_id_domain(c("message_id_header")).alias("message_id_domain"),
        match_list_domain(c("list_id")).alias("list_domain"),
        match_unsub_domain(c("unsubscribe_link")).alias("unsub_domain"),
        F.lower("precedence").alias("precedence"),
        F.lower("auto_submitted").alias("auto_submitted"),
    ]


ADDRESS_COLUMNS = ("from_address", "sender_address", "reply_to_address")


def select_match_features(mail, keep: tuple = ("message_id",)):
    """The matcher's features in staged projections (each regex pass runs once per row).

    Same values as ``match_features``; the trimmed and display-name-stripped addresses are
    columns of their own projections so later steps reference them without re-evaluation.
    """
    c = F.col
    s1 = mail.select(*keep, "from_domain", "message_id_header", "list_id", "unsubscribe_link", "precedence",
                     "auto_submitted", *ADDRESS_COLUMNS,
                     *[F.lower(js_trim(c(a))).alias(f"_t_{a}") for a in ADDRESS_COLUMNS])
    s2 = s1.select("*", *[F.coalesce(_first(c(f"_t_{a}"), "<([^>]+)>"), c(f"_t_{a}")).alias(f"_a_{a}")
                          for a in ADDRESS_COLUMNS])

    def norm(a):
        x = c(f"_a_{a}")
        n = F.when(F.instr(x, "@") > 0, F.concat(F.split_part(F.split_part(x, F.lit("@"), F.lit(1)), F.lit("+"),
                                                              F.lit(1)), F.lit("@"),
                                                 F.split_part(x, F.lit("@"), F.lit(2)))).otherwise(x)
        return F.when(c(a).isNull() | (c(a) == ""), F.lit(None).cast("string")).otherwise(n)

    s3 = s2.select(*keep, "from_domain", "message_id_header", "list_id", "unsubscribe_link", "precedence",
                   "auto_submitted", *[norm(a).alias(f"_n_{a}") for a in ADDRESS_COLUMNS])
    fa = c("_n_from_address")
    return s3.select(
        *keep, fa.alias("from_address"), c("_n_sender_address").alias("sender_address"),
        c("_n_reply_to_address").alias("reply_to_address"),
        F.coalesce(_empty_to_null(F.lower("from_domain")),
                   F.when(F.instr(fa, "@") > 0, F.split_part(fa, F.lit("@"), F.lit(2)))).alias("from_domain"),
        match_message_id_domain(c("message_id_header")).alias("message_id_domain"),
        match_list_domain(c("list_id")).alias("list_domain"),
        match_unsub_domain(c("unsubscribe_link")).alias("unsub_domain"),
        F.lower("precedence").alias("precedence"), F.lower("auto_submitted").alias("auto_submitted"))


# --- mining flavour (K2) ------------------------------------------------------

def _replace_whole(col: Column, pattern: str) -> Column:
    """PostgreSQL REGEXP_REPLACE(x, '.*P.*', '\\1'): the capture, or x itself when no match."""
    return F.regexp_replace(col, "(?s)" + pattern, "$1")


def mining_address(col: Column) -> Column:
    lo = F.lower(col)
    return (F.when(col.isNull(), F.lit(None).cast("string"))
            .when(F.instr(col, "@") > 0,
                  F.concat(F.split_part(F.split_part(lo, F.lit("@"), F.lit(1)), F.lit("+"), F.lit(1)), F.lit("@"),
                           F.lower(F.split_part(col, F.lit("@"), F.lit(2)))))
            .otherwise(lo))


def mining_list_domain(col: Column) -> Column:
    return F.lower(F.nullif(_replace_whole(col, ".*<([^>]+)>.*"), F.lit("")))


def mining_unsub_domain(col: Column) -> Column:
    return F.coalesce(F.lower(F.nullif(_replace_whole(col, ".*https?://([^/>,;]+).*"), F.lit(""))),
                      F.lower(F.nullif(_replace_whole(col, ".*@([^> ,;]+).*"), F.lit(""))))


def mining_message_id_domain(col: Column) -> Column:
    return F.lower(F.nullif(_replace_whole(col, ".*@([^>]+)>.*"), F.lit("")))


def mining_return_path_clean(col: Column) -> Column:
    return (F.when(col.isNull(), F.lit(None).cast("string"))
            .when(col.rlike("(?s)<.*>"), F.lower(_replace_whole(col, ".*<([^>]+)>.*")))
            .otherwise(F.lower(col)))


def mining_return_path(col: Column, staged: bool = False) -> Column:
    """Normalised return path; ``staged=True`` when ``col`` is already the cleaned value."""
    clean = col if staged else mining_return_path_clean(col)
    return F.when(F.instr(clean, "@") > 0,
                  F.concat(F.split_part(F.split_part(clean, F.lit("@"), F.lit(1)), F.lit("+"), F.lit(1)), F.lit("@"),
                           F.split_part(clean, F.lit("@"), F.lit(2)))).otherwise(clean)


def mining_features(return_path_clean: str | None = None) -> list[Column]:
    """The miner's ten feature columns over the joined mail/header row.

    Pass ``return_path_clean`` (a column holding ``mining_return_path_clean``) when the cleaned
    return path was staged in an earlier projection.
    """
    c = F.col
    return [
        F.lower("from_domain").alias("from_domain"),
        mining_list_domain(c("list_id")).alias("list_domain"),
        mining_unsub_domain(c("unsubscribe_link")).alias("unsub_domain"),
        mining_message_id_domain(c("message_id_header")).alias("message_id_domain"),
        c("precedence").alias("precedence"),
        c("auto_submitted").alias("auto_submitted"),
        mining_address(c("from_address")).alias("from_address"),
        mining_address(c("sender_address")).alias("sender_address"),
        mining_address(c("reply_to_address")).alias("reply_to_address"),
        (mining_return_path(c(return_path_clean), staged=True) if return_path_clean
         else mining_return_path(c("return_path"))).alias("return_path"),
    ]


# --- SQL twins (DuckDB) for the oracles ------------------------------------------

def sql_mining_address(x: str) -> str:
    return (f"case when {x} is null then null when position('@' in {x}) > 0 then "
            f"split_part(split_part(lower({x}), '@', 1), '+', 1) || '@' || lower(split_part({x}, '@', 2)) "
            f"else lower({x}) end")


SQL_MINING_FEATURES = {
    "from_domain": "lower(from_domain)",
    "list_domain": r"lower(nullif(regexp_replace(list_id, '(?s).*<([^>]+)>.*', '\1'), ''))",
    "unsub_domain": (r"coalesce(lower(nullif(regexp_replace(unsubscribe_link, '(?s).*https?://([^/>,;]+).*', '\1'), '')), "
                     r"lower(nullif(regexp_replace(unsubscribe_link, '(?s).*@([^> ,;]+).*', '\1'), '')))"),
    "message_id_domain": r"lower(nullif(regexp_replace(message_id_header, '(?s).*@([^>]+)>.*', '\1'), ''))",
    "precedence": "precedence",
    "auto_submitted": "auto_submitted",
    "from_address": sql_mining_address("from_address"),
    "sender_address": sql_mining_address("sender_address"),
    "reply_to_address": sql_mining_address("reply_to_address"),
    "return_path": ("case when rp_clean is null then null when position('@' in rp_clean) > 0 then "
                    "split_part(split_part(rp_clean, '@', 1), '+', 1) || '@' || split_part(rp_clean, '@', 2) "
                    "else rp_clean end"),
}
SQL_RP_CLEAN = (r"case when return_path is null then null when regexp_matches(return_path, '(?s)<.*>') "
                r"then lower(regexp_replace(return_path, '(?s).*<([^>]+)>.*', '\1')) else lower(return_path) end")


def sql_match_address(x: str) -> str:
    a = f"lower(trim({x}))"
    a2 = f"coalesce(nullif(regexp_extract({a}, '<([^>]+)>', 1), ''), {a})"
    return (f"case when {x} is null or {x} = '' then null when position('@' in {a2}) > 0 then "
            f"split_part(split_part({a2}, '@', 1), '+', 1) || '@' || split_part({a2}, '@', 2) else {a2} end")


def sql_match_features() -> dict[str, str]:
    fa = sql_match_address("from_address")
    return {
        "from_address": fa,
        "sender_address": sql_match_address("sender_address"),
        "reply_to_address": sql_match_address("reply_to_address"),
        "from_domain": (f"coalesce(nullif(lower(from_domain), ''), case when position('@' in ({fa})) > 0 "
                        f"then split_part(({fa}), '@', 2) end)"),
        "message_id_domain": "lower(nullif(regexp_extract(message_id_header, '@([^>]+)', 1), ''))",
        "list_domain": "lower(nullif(regexp_extract(list_id, '<([^>]+)>', 1), ''))",
        "unsub_domain": ("lower(coalesce(nullif(regexp_extract(unsubscribe_link, 'https?://([^/>,;\\s]+)', 1), ''), "
                         "nullif(regexp_extract(unsubscribe_link, 'mailto:.*@([^>,;\\s]+)', 1), ''), "
                         "nullif(regexp_extract(unsubscribe_link, '@([^>,;\\s]+)', 1), '')))"),
        "precedence": "lower(precedence)",
        "auto_submitted": "lower(auto_submitted)",
    }
