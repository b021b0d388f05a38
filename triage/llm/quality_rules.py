"""Operator 5 [native]: quality rules with risk-controlled thresholds.

Every text is measured once (words, characters in words, symbols, repeated lines, words in
repeated 8-word windows). A base rule fails texts that are too short or repeat themselves. Beyond
it, each rule of ``RULES`` may reject a text whose value lies above a cutoff, per stratum.

Cutoffs come from labelled holdouts: of ``n`` documents labelled good in a stratum, a cutoff would
reject ``k``. It is certified if the exact binomial (Clopper-Pearson) bound says that its true rate
of false rejections is at most ``risk / number of rules``: P[Bin(n, risk/rules) <= k] at most
``alpha / tests``, Bonferroni-corrected for all strata, rules and cutoffs on the grid. So with
confidence ``1 - alpha``, in every stratum at once, at most ``risk`` of good documents are
rejected by all rules together. Each rule takes its lowest certified cutoff; without one (too few
labels) it rejects nothing. Cutoffs come from a fixed grid, so no label is used to propose one.

All in DataFrame functions: one pass over the texts, one cut of the numbers, one join with the
labels. Edge cases: a null or empty text has no words and fails the base rule; a null stratum is a
stratum; a document labelled both ways is not good; labels without a document or of null are left
out; repeated rows are each measured; a null doc_id is measured but has no label; other columns are
not read; empty tables give no rows, and no labels no cutoffs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triage.llm.common import cut

WINDOW = 8
#: rule: (value from the measures, grid of cutoffs)
RULES = {
    "symbols_per_word": ("n_symbols / n_words", (0.02, 0.05, 0.1, 0.2, 0.4, 0.8)),
    "dup_line_share": ("n_dup_lines / n_lines", (0.05, 0.1, 0.2, 0.3, 0.5)),
    "repeat_word_share": ("n_repeat_words / n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.25)),
    "mean_word_length": ("word_chars / n_words", (8.0, 9.0, 10.0, 12.0, 15.0)),
    "short_word_share": ("n_words / word_chars", (0.25, 0.3, 0.4, 0.5, 0.7)),
}
RISK, ALPHA = 0.02, 0.05
SPACE = r"[\x20\x09-\x0D]+"


def measures(docs: DataFrame, stratum: str | None = "lang") -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)."""
    of = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit("")
    d = docs.select(F.col("doc_id").cast("long"), of.alias("stratum"), F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("doc_id", "stratum", "t", F.array_remove(F.split("t", SPACE), "").alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    d = d.select(
        "doc_id", "stratum", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= WINDOW, F.expr(
            f"transform(sequence(1, size(w) - {WINDOW - 1}), i -> xxhash64(slice(w, i, {WINDOW})))")).alias("h"))
    # only texts with a repeated window sort theirs; every step is one projection, so nothing is redone
    keep = [c for c in d.columns if c != "h"]
    d = d.select(*keep, F.when(F.size(F.array_distinct("h")) < F.size("h"),
                               F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"))
    d = d.select(*keep, F.array_sort(F.array_distinct(F.flatten(F.expr(
        "zip_with(slice(s, 1, size(s) - 1), slice(s, 2, size(s)), (a, b) -> if(a.x = b.x, array(a.i, b.i), array()))")))).alias("p"))
    covered = F.expr(f"aggregate(zip_with(p, slice(p, 2, size(p)), (a, b) -> least(coalesce(b - a, {WINDOW}), {WINDOW})), 0, (t, x) -> t + x)")
    return d.select(*keep, F.coalesce(F.when(F.size("p") > 0, covered), F.lit(0)).cast("long").alias("n_repeat_words"))


BROADCAST_BYTES = 8 << 20  # cutoffs of all strata that are broadcast at most


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_value(rule: str) -> Column:
    top, _, bottom = RULES[rule][0].partition(" / ")
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom))


def binomial_log_cdf(n: str, k: str, p: float) -> Column:
    """log P[Bin(n, p) <= k], exact, term by term in logarithms."""
    step = math.log(p) - math.log1p(-p)
    return F.expr(f"""aggregate(
        if({k} >= 1, sequence(1L, {k}), array()),
        named_struct('t', {n} * {math.log1p(-p)!r}D, 's', {n} * {math.log1p(-p)!r}D),
        (a, i) -> named_struct(
            't', a.t + ln(({n} - i + 1) / i) + {step!r}D,
            's', greatest(a.s, a.t + ln(({n} - i + 1) / i) + {step!r}D)
                 + log1p(exp(-abs(a.s - (a.t + ln(({n} - i + 1) / i) + {step!r}D))))),
        a -> a.s)""")


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """(stratum, rule, cutoff, n, k): the lowest certified cutoff of each rule and stratum."""
    good = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("q")).filter("doc_id is not null and q is not null") \
        .groupBy("doc_id").agg(F.min("q").alias("q")).filter("q = 1").select("doc_id")
    held = measured.filter(~base_failed()).join(good, "doc_id").select("stratum", *[rule_value(r).alias(r) for r in RULES])
    grid = [(r, c) for r, (_, cs) in RULES.items() for c in cs]
    counts = held.groupBy("stratum").agg(F.count("*").alias("n"), *[
        F.coalesce(F.sum((F.col(r) > c).cast("long")), F.lit(0)).alias(f"k{i}") for i, (r, c) in enumerate(grid)])
    rows = counts.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"k{i}").alias("k")) for i, (r, c) in enumerate(grid)])).alias("g"))
    rows = rows.select("stratum", "n", "g.*")
    tests = rows.agg(F.count("*").alias("tests"))  # one row
    each = risk / len(RULES)
    sure = rows.join(F.broadcast(tests)).filter(F.col("k") < F.lit(each) * F.col("n")).filter(
        binomial_log_cdf("n", "k", each) <= F.log(F.lit(alpha) / F.col("tests")))
    return sure.groupBy("stratum", "rule").agg(F.min_by(F.struct("cutoff", "n", "k"), "cutoff").alias("c")).select("stratum", "rule", "c.*")


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """Measures of every row of ``docs`` with base_failed, kept and the rules that reject it."""
    measured = cut(measures(docs, stratum))
    chosen = cutoffs(measured, labels, risk, alpha).groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])
    chosen = cut(chosen)
    # a few strata hold all rows: their cutoffs go to the rows; many strata spread over a shuffle by themselves
    few = chosen.agg(F.count("*").alias("n"), F.max(F.length("stratum")).alias("w")).first()
    if few.n * ((few.w or 0) + 64) <= BROADCAST_BYTES:
        chosen = F.broadcast(chosen)
    d = measured.join(chosen, "stratum", "left").withColumn("base_failed", base_failed())
    hits = F.array_compact(F.array(*[F.when(rule_value(r) > F.col(f"cut_{r}"), F.lit(r)) for r in RULES]))
    return d.withColumn("rejected_by", hits).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)) \
        .drop(*[f"cut_{r}" for r in RULES])
