"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF001
from triage.llm import decontam, licenses, pieces, pii, quality, quality_rules, secret_scan, url_filter
from triage.llm.jaccard import jaccard_join
from triage.llm.suffix_dedup import remove_repeats

PROSE = " ".join(f"word{i} of a longer text" for i in range(60))
LONG = "x" * 300_000
MANY = " ".join(f"w{i}" for i in range(30_000))
ROWS = [(1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "one", None), (5, PROSE, "en"), (6, PROSE, "en"),
        (6, PROSE, "en"), (None, "some text without an id " + PROSE[:40], "de"), (7, LONG, "en"), (8, MANY, "en")]
CLASH = ("score", "n", "ids", "spans", "token", "m", "rid", "at", "cls", "kept", "license", "k", "h", "w", "t", "stratum",
         "n_words", "count", "root", "node", "lossless", "prefix", "base", "y", "key", "own")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit(None).cast("string") if i % 2 else F.lit(i) for i, c in enumerate(CLASH)})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def labels(spark, rows=((5, 1, 0), (2, 0, 0), (99, 1, 0), (None, 1, 0), (4, None, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def by_id(rows, *cols):
    return sorted((tuple(r[c] for c in ("doc_id", *cols)) for r in rows), key=str)


def test_jaccard(docs, none):
    got = by_id(jaccard_join(docs, 4, 85, 100).collect(), "n_shingles", "component_id")
    n = len(PROSE.split()) - 3
    assert (1, 0, 1) in got and (2, 0, 2) in got and (3, 0, 3) in got and (4, 1, 4) in got
    assert got.count((6, len({tuple(PROSE.split()[i:i + 4]) for i in range(n)}), 5)) == 2
    assert (7, 1, 7) in got and (8, 29_997, 8) in got and len(got) == len(ROWS)
    assert any(r[0] is None and r[2] is None for r in got)
    assert jaccard_join(none).collect() == []


@pytest.mark.parametrize("keep", ["none", "first"])
def test_suffix_dedup(docs, none, keep):
    got = {(r.doc_id, r.n_bytes): r for r in remove_repeats(docs, 200, keep).collect()}
    assert got[(1, 0)].kept == b"" and got[(2, 0)].spans == [] and got[(4, 3)].kept == b"one"
    assert bytes(got[(8, len(MANY))].kept) == MANY.encode()
    assert len(got[(7, len(LONG))].kept) == (0 if keep == "none" else 1)  # copies may overlap the first
    assert len(got[(5, len(PROSE))].kept) == (0 if keep == "none" else len(PROSE))
    assert len(got[(6, len(PROSE))].kept) == 0
    assert remove_repeats(none, 200, keep).collect() == []


def test_quality(spark, docs, none):
    for labelled in (labels(spark), labels(spark, ((5, 1, 0),)), labels(spark, ())):
        model = quality.fit(docs, labelled, "quality")
        got = quality.score(docs, model).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1  # the bias alone
    assert quality.score(none, model).collect() == []
    wide = quality.with_score(docs.drop("score"), model)
    assert wide.columns == [c for c in docs.columns if c != "score"] + ["score"] and wide.count() == len(ROWS)


def test_rules(spark, docs, none):
    got = quality_rules.apply_rules(docs, labels(spark)).collect()
    assert len(got) == len(ROWS) and {r.doc_id for r in got if r.kept} >= {5, 6, 8}
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (1, 2, 3, 4, 7))
    assert quality_rules.apply_rules(none, labels(spark)).collect() == []
    assert quality_rules.apply_rules(docs, labels(spark, ())).count() == len(ROWS)
    assert quality_rules.apply_rules(docs, labels(spark), stratum=None).count() == len(ROWS)


def test_scans(docs, none):
    for scan in (secret_scan.scan, pii.scan):
        got = scan(docs).collect()
        assert len(got) == len(ROWS) and all(r.base == [] for r in got)
        assert scan(none).collect() == []
    masked = pii.masked(docs)
    assert masked.columns == docs.columns and masked.count() == len(ROWS)
    assert masked.filter("text is null").count() == 1


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame([(1, "one"), (1, "one"), (2, None), (3, ""), (4, "..."), (None, PROSE), (5, " ".join(PROSE.upper().split()[7:40]))],
                                  "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("g", F.lit("x"))
    got = by_id(decontam.find_leaks(docs, bench).collect(), "item_id", "first_word", "similarity")
    assert got == [(4, 1, 0, 1.0), (5, 5, 7, 1.0), (6, 5, 7, 1.0)]
    assert decontam.find_leaks(none, bench).collect() == [] == decontam.find_leaks(docs, bench.limit(0)).collect()


def test_licenses(docs, none):
    files = docs.withColumn("path", F.when(F.col("doc_id") != 4, F.concat(F.lit("a/b/"), F.col("doc_id").cast("string"))))
    files = files.unionByName(files.filter("doc_id = 5").withColumn("path", F.lit("a/LICENSE")).withColumn("text", F.lit("\nReleased under the MIT License.")))
    got = by_id(licenses.scan(files).collect(), "path", "license", "origin", "from_dir")
    assert (5, "a/LICENSE", "MIT", "own", None) in got and got.count((6, "a/b/6", "MIT", "inherited", "a")) == 2
    assert (4, None, None, "none", None) in got and len(got) == len(ROWS) + 1
    assert licenses.scan(files.limit(0)).collect() == []


def test_pieces(docs, none):
    rows = pieces.encoded(docs, dropout=0.2, seed=3)
    got = rows.collect()
    assert len(got) == len(ROWS) and all(r.lossless for r in got)
    assert all(r.ids == [] for r in got if r.doc_id in (1, 2)) and len({tuple(r.ids) for r in got if r.doc_id == 6}) == 1
    back = {r.doc_id: r.text for r in pieces.decoded(rows).collect()}
    assert back[1] == back[2] == "" and back[5] == PROSE and back[7] == LONG and back[8] == MANY
    assert pieces.encoded(none).collect() == []


def test_urls(spark):
    cap = spark.createDataFrame([(1, None, 10), (2, "not a url", 10), (3, "http://a.org/x", None), (4, "http://WWW.A.org./x/y?q#f", 50), (4, "http://WWW.A.org./x/y?q#f", 50),
                                 (None, "http://b.a.org", 5)], "page_id long, url string, s long") \
        .select("page_id", "url", F.timestamp_seconds("s").alias("fetched"), F.lit(1).alias("key"), F.lit("x").alias("row"))
    ent = spark.createDataFrame([("a.org", "block", 1), ("a.org", "block", 1), ("a.org", "remove", 40), ("a.org/x/", "allow", 45), (None, "block", 1), ("a.org", "allow", None), ("a.org/x/", "block", 45)],
                                "key string, action string, s long").select("key", "action", F.timestamp_seconds("s").alias("since"))
    got = sorted(((r.page_id, r.verdict, r.key) for r in url_filter.judge(cap, ent).collect()), key=str)
    assert got == [(1, "none", None), (2, "none", None), (3, "none", None), (4, "allow", "a.org/x/"), (4, "allow", "a.org/x/"), (None, "block", "a.org")]
    assert url_filter.judge(cap.limit(0), ent).collect() == []
    assert {r.verdict for r in url_filter.judge(cap, ent.limit(0)).collect()} == {"none"}


def test_pipeline_stages(spark, docs, none):
    base = docs.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), F.lit(1).alias("extra"))
    for source in (base, base.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, source, SF001)
            if name != "SentencePiece":
                assert out.columns == source.columns, name
            n = out.count()
            if name == "n-gram Jaccard join" and source is base:
                assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "3", "4", "5", "7", "8", "None"]
            assert n <= len(ROWS) and (source is base or n == 0)
