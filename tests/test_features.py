"""Edge rows for the two feature flavours and the scoring rules (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from triage.functions import features as ft
from triage.plans.gateway import priority_score

S = "v string"


def ev(spark, col_fn, values):
    df = spark.createDataFrame([(v,) for v in values], S)
    return [r[0] for r in df.select(col_fn(F.col("v"))).collect()]


def test_match_address_strips_display_name_tag_and_space(spark):
    assert ev(spark, ft.match_address, [' "A B" <Jo+x@Ex.com> ']) == ["jo@ex.com"]


def test_two_at_signs_keep_second_piece(spark):  # T5
    assert ev(spark, ft.match_address, ["a@b@c"]) == ["a@b"]
    assert ev(spark, ft.mining_address, ["a@b@c"]) == ["a@b"]


def test_empty_address(spark):  # T4
    assert ev(spark, ft.match_address, ["", None]) == [None, None]
    assert ev(spark, ft.mining_address, [""]) == [""]


def test_mining_address_keeps_display_name(spark):  # T4
    assert ev(spark, ft.mining_address, [' "A B" <Jo+x@Ex.com> ']) == [' "a b" <jo@ex.com> ']


def test_list_domain_flavours(spark):  # T1, T3
    assert ev(spark, ft.match_list_domain, ["weekly", "<a.x> <b.y>"]) == [None, "a.x"]
    assert ev(spark, ft.mining_list_domain, ["weekly", "<a.x> <b.y>"]) == ["weekly", "b.y"]


def test_unsub_domain_flavours(spark):  # T2, T3
    vals = ["<mailto:q@z.io>", "<https://One.io/a>,<https://two.io/b>"]
    assert ev(spark, ft.match_unsub_domain, vals) == ["z.io", "one.io"]
    assert ev(spark, ft.mining_unsub_domain, vals) == ["<mailto:q@z.io>", "two.io"]


def test_message_id_domain_flavours(spark):  # T1, T3
    assert ev(spark, ft.match_message_id_domain, ["<1@host"]) == ["host"]
    assert ev(spark, ft.mining_message_id_domain, ["<1@host"]) == ["<1@host"]


def test_js_trim_unicode_space(spark):
    assert ev(spark, ft.js_trim, ["  x ﻿", "\tx\n"]) == ["x", "x"]


def test_staged_match_features_equal_column_form(spark, fx01):
    staged = fx01.mail.transform(ft.select_match_features)
    plain = fx01.mail.select("message_id", *ft.match_features(fx01.mail))
    cols = plain.columns
    assert staged.select(*cols).exceptAll(plain).count() == 0
    assert plain.exceptAll(staged.select(*cols)).count() == 0


def test_priority_score_lists(spark):  # T11, T13
    df = spark.createDataFrame([(10,), (15,), (20,), (30,)], "p int")
    got = [r[0] for r in df.select(priority_score(F.col("p"), F.lit(95), F.lit(90))).collect()]
    assert got == [95, 55, 75, 55]


def test_priority_score_rules(spark):  # T11, T12
    df = spark.createDataFrame([(10, 99), (10, 92), (10, None)], "p int, prec int")
    got = [r[0] for r in df.select(priority_score(F.col("p"), F.col("prec"))).collect()]
    assert got == [90, 85, 80]
