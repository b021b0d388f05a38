"""Body cleaning edge rows (T29-T32) and properties."""

from pyspark.sql import functions as F

from triage.plans.text import clean_bodies


def clean(spark, rows, limit=12000):
    df = spark.createDataFrame([(f"m{i}", c, t) for i, (c, t) in enumerate(rows)],
                               "message_id string, content string, content_type string")
    return [r.asDict() for r in clean_bodies(df, limit).orderBy("message_id").collect()]


def test_double_decode(spark):  # T31
    out = clean(spark, [("<p>it&amp;#39;s</p>", "html")])
    assert out[0]["body_text"] == "it's"


def test_bracket_link_vanishes_on_html_survives_on_plain(spark):  # T30
    out = clean(spark, [("<p>x</p><http://u.v>", "html"), ("see <http://u.v>", "text")])
    assert out[0]["body_text"] == "x"
    assert out[1]["body_text"] == "see http://u.v"


def test_hard_cut_when_no_break_beyond_60_percent(spark):  # T32
    text = "a" * 18 + ". " + "b" * 80
    out = clean(spark, [(text, "text")], limit=50)
    assert out[0]["body_text"] == text[:50]
    assert out[0]["body_truncated"] is True


def test_sentence_cut(spark):  # T32
    text = "a" * 38 + ". " + "b" * 80
    out = clean(spark, [(text, "text")], limit=50)
    assert out[0]["body_text"] == "a" * 38 + "."


def test_paragraph_cut(spark):  # T32
    text = "a" * 35 + "\n\n" + "b" * 80
    out = clean(spark, [(text, "text")], limit=50)
    assert out[0]["body_text"] == "a" * 35


def test_whitespace_plain_falls_back_and_keeps_label(spark):  # T29
    out = clean(spark, [("   ", "text")])
    assert out[0]["body_text"] == "" and out[0]["body_source"] == "text"


def test_numeric_and_named_entities(spark):
    out = clean(spark, [("<p>A&#66;&#x43; &lt;d&gt; &nbsp;e</p>", "html")])
    assert out[0]["body_text"] == "ABC <d> e"


def test_script_style_and_whitespace(spark):
    html = "<style>p{}</style><script>var t='</p>';</script><p>one</p>\r\n\t<br/>two​   three"
    out = clean(spark, [(html, "html")])
    assert out[0]["body_text"] == "one\n\ntwo three"


def test_truncation_bound(spark, fx01):
    """At most ``limit`` characters, except a sentence cut found exactly at the limit keeps its
    period (lastIndexOf may return ``limit``; slice(0, dot + 1) is then limit + 1 long)."""
    for limit in (500, 3000):
        df = clean_bodies(fx01.body, limit)
        assert df.filter(F.length("body_text") > limit + 1).count() == 0
        over = df.filter(F.length("body_text") == limit + 1)
        assert over.filter(~F.col("body_text").endswith(".")).count() == 0
        assert df.filter(~F.col("body_truncated") & (F.col("body_chars") > limit)).count() == 0


def test_tokens_estimate(spark):
    out = clean(spark, [("abcde", "text"), ("", "text")])
    assert out[0]["tokens_est"] == 2 and out[1]["tokens_est"] == 0


def test_wrapped_safe_link_is_decoded(spark):
    wrapped = ("https://eur01.safelinks.protection.outlook.com/?url=https%3A%2F%2Fexample.org%2Fa%3Fb%3D1"
               "&data=x&reserved=0")
    out = clean(spark, [(f"see {wrapped} now", "text"), ("plain https://example.org/x stays", "text")])
    assert out[0]["body_text"] == "see https://example.org/a?b=1 now"
    assert out[1]["body_text"] == "plain https://example.org/x stays"


def test_entities_that_used_to_raise(spark):
    out = clean(spark, [("<p>&#55357;&#56832; &#99999999999999999999999999; x&#55357;y</p>", "html"),
                        ("<p>&#38;#39; &#39;</p>", "html"), (f"<p>&#{'9' * 400};z</p>", "html")])
    assert out[0]["body_text"].startswith("\U0001f600") and out[0]["body_text"].endswith("x\ufffdy")
    assert out[1]["body_text"] == "&#39; '"
    assert out[2]["body_text"].endswith("z")


def test_wrapped_link_that_is_a_prefix_of_another(spark):
    host = "https://a.safelinks.protection.outlook.com/?url=https%3A%2F%2Fx.org"
    out = clean(spark, [(f"{host} and {host}%2Fy&data=1", "text")])
    assert out[0]["body_text"] == "https://x.org and https://x.org/y"


def test_empty_body_has_no_hash(spark):
    assert clean(spark, [("", "text")])[0]["body_hash"] is None


def test_bodies_that_differ_late_are_no_duplicates(spark):
    from types import SimpleNamespace

    from triage.plans.text import content_duplicates, text_metrics
    long = "word " * 4000
    body = spark.createDataFrame([("a", long + "one", "text"), ("b", long + "two", "text"), ("c", long + "one", "text")],
                                 "message_id string, content string, content_type string")
    fx = SimpleNamespace(spark=spark, body=body)
    assert [(r.message_id, r.duplicate_of) for r in content_duplicates(fx).orderBy("message_id").collect()] == [("a", "a"), ("c", "a")]
    assert {r.word_count for r in text_metrics(fx).collect()} == {4001}


def test_trim_looks_at_the_ends_only(spark):
    """Same texts as by the pattern, which tried every position of every body."""
    from triage.functions.text import JS_SPACE, JS_SPACE_CHARS, js_trim
    ends = [*JS_SPACE_CHARS, "\u0085", "​", "x", "", " \u0085", "\u0085 ", "\r\n", "\n\u0085\u0085", "　 \u0085"]
    texts = [a + m + b for a in ends for b in ends for m in ("", "a b", "é\n\U0001f600")] + [None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    old = F.regexp_replace("x", f"^{JS_SPACE}+|{JS_SPACE}+$", "")
    assert df.filter(~js_trim(F.col("x")).eqNullSafe(old)).collect() == []
    assert len(JS_SPACE_CHARS) == 25 and "trim(" in df.select(js_trim(F.col("x")))._jdf.queryExecution().optimizedPlan().toString().lower()
