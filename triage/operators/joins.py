"""Join operators (C3-C5, C13-C15, C19). Which side is broadcast is left to adaptive execution.

* ``join_null_safe``: SQL ``GROUP BY`` treats null as a key; re-joining two aggregates on such
  keys must use ``<=>`` or the null group is lost.
* ``contains_join``: theta join "text contains pattern" (C13): a dictionary of the distinct texts
  meets an index of the patterns' first characters.
* ``first_by_priority``: argmin after a join (C15) as ``min_by`` over a total order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    r = right.select(*[c(k).alias(f"_r_{k}") for k in keys], *[x for x in right.columns if x not in keys])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def contains_join(texts: DataFrame, text_col: str, patterns: DataFrame, pattern_col: str, gram: int = 4, same: str | None = None) -> DataFrame:
    """Rows of ``texts`` x ``patterns`` where text contains pattern (non-empty patterns).

    The distinct texts are a dictionary that is searched once, however many rows hold a text. The
    patterns are indexed by their first ``gram`` characters (all of a shorter one): each distinct
    text gives its distinct substrings of those one to ``gram`` lengths, an equi-join finds the
    patterns that may start there, and the whole pattern is compared. Hits come back to the rows by
    an equi-join on the text, so what is exploded grows with the dictionary and not with the rows.

    ``same``: a column of few values that text and pattern must share. Then a text gives substrings
    only of the lengths and where the first two characters are those of a pattern of its value.
    """
    if same:
        return _contains_same(texts, text_col, patterns, pattern_col, gram, same)
    pats = patterns.filter(F.length(pattern_col) > 0).withColumn("_gram", F.substring(pattern_col, 1, gram))
    lengths = pats.agg(F.collect_set(F.length("_gram")).alias("_lens"))  # one row of at most ``gram`` numbers
    grams = F.expr("""array_distinct(flatten(transform(filter(_lens, n -> n <= length(_text)),
        n -> transform(sequence(1, length(_text) - n + 1), i -> substring(_text, i, n)))))""")
    # a null text counts as the empty one, which holds no pattern: a filter of nulls, written or inferred, would be
    # pushed below the projections that make the text and make it again
    text = F.coalesce(texts[text_col], F.lit(""))
    words = texts.select(text.alias("_text")).distinct().withColumn("_lens", lengths.scalar())
    starts = words.select("_text", F.explode_outer(grams).alias("_gram"))  # outer: else the filter would build grams twice
    hits = (starts.join(pats.withColumnRenamed(pattern_col, "_pattern"), "_gram").filter(F.expr("contains(_text, _pattern)"))
            .select("_text", c("_pattern").alias(pattern_col), *[x for x in patterns.columns if x != pattern_col]))
    return texts.join(hits, text == hits["_text"]).drop("_text")


def _contains_same(texts: DataFrame, text_col: str, patterns: DataFrame, pattern_col: str, gram: int, same: str) -> DataFrame:
    pats = patterns.filter(F.length(pattern_col) > 0).withColumn("_gram", F.substring(pattern_col, 1, gram))
    known = pats.groupBy(same).agg(F.collect_set(F.length("_gram")).alias("_lens"), F.collect_set(F.substring("_gram", 1, 2)).alias("_heads"))
    # a text is small beside its substrings: they are made in as many tasks as there are partitions
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = (texts.select(same, c(text_col).alias("_text")).filter("_text <> ''").distinct().repartition(parts, same, "_text")
             .join(F.broadcast(known), same))
    # where many first characters are told apart, looking for them costs more than it saves
    grams = F.expr("""array_distinct(flatten(transform(
        filter(sequence(1, length(_text)), i -> size(_heads) > 100
            or array_contains(_heads, substring(_text, i, 2)) or array_contains(_heads, substring(_text, i, 1))),
        i -> transform(filter(_lens, n -> i + n - 1 <= length(_text)), n -> substring(_text, i, n)))))""")
    starts = words.select(same, "_text", F.explode_outer(grams).alias("_gram"))
    hits = (starts.join(pats.withColumnRenamed(pattern_col, "_pattern"), [same, "_gram"]).filter(F.expr("contains(_text, _pattern)"))
            .select(same, "_text", c("_pattern").alias(pattern_col), *[x for x in patterns.columns if x not in (pattern_col, same)]))
    return texts.withColumn("_text", c(text_col)).join(hits, [same, "_text"]).drop("_text")


def first_by_priority(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                      value_cols: Sequence[str]) -> DataFrame:
    """Per key, the row with the smallest ``order`` tuple (C15), as a partial aggregate."""
    ordering = F.struct(*[c(o) if isinstance(o, str) else o for o in order])
    best = F.min_by(F.struct(*[c(v) for v in value_cols]), ordering).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")
