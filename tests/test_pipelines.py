"""Pipeline properties and brute-force checks."""

from pyspark.sql import functions as F

from triage.functions.features import FEATURES
from triage.plans import gateway as gw
from triage.plans import mining, sync, work
from triage.plans.ingest import body_responses, parse_body_response
from tests.conftest import rows


def test_unpivot_rows_equal_non_empty_features(fx01):
    f = mining.feature_rows(fx01)
    base = mining.mining_base(fx01).select(*mining.mining_features())
    expected = base.select(sum(F.when(F.col(x).isNotNull() & (F.col(x) != ""), 1).otherwise(0)
                               for x in FEATURES).alias("n")).agg(F.sum("n")).first()[0]
    assert f.count() == expected


def test_mining_against_counting_by_hand(spark, fx01):
    """Each key's rows, winners and dates counted row by row in plain Python."""
    from collections import Counter, defaultdict
    seen = defaultdict(list)
    for r in mining.feature_rows(fx01).collect():
        seen[r.feature, r.key_value].append((r.primary_category, r.recommended_action or "", r.decided_at))
    want = []
    for (feature, key), got in seen.items():
        cats, acts = Counter(x[0] for x in got), Counter(x[1] for x in got)
        top = lambda n: min(n.items(), key=lambda kv: (-kv[1], kv[0]))
        want.append((feature, key, len(got), len(cats) * len(got) * len(acts), top(cats)[1], top(cats)[0], top(acts)[0],
                     top(acts)[1], min(x[2] for x in got), max(x[2] for x in got)))
    lean = mining.rule_metrics(fx01).select(
        "feature", "key_value", "support", "joined_rows", "majority_cat_count", "majority_category",
        "majority_action", "majority_action_count", "first_seen", "last_seen")
    assert rows(lean) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_counts_are_long(fx01):
    kinds = dict(mining.rule_metrics(fx01).dtypes)
    assert {kinds[x] for x in ("support", "majority_cat_count", "majority_action_count", "total_messages")} == {"bigint"}


def test_accepted_and_borderline_disjoint(fx01):
    m = mining.rule_metrics(fx01)
    a = mining.accepted_rules(m).select("feature", "key_value")
    b = mining.borderline_rules(m).select("feature", "key_value")
    assert a.count() > 0 and b.count() > 0
    assert a.intersect(b).count() == 0


def test_gateway_one_row_per_mail(fx01):
    g = gw.gateway(fx01.mail, fx01.list_entry, fx01.rule)
    assert g.count() == fx01.mail.count()
    assert g.select("message_id").distinct().count() == g.count()
    srcs = {r[0] for r in g.select("classification_source").distinct().collect()}
    assert {"classification_rules", "needs_ai"} <= srcs and any(s.startswith("contact_lists_") for s in srcs)


def test_state_diff_of_state_with_itself_is_empty(fx01):
    class SelfObserved:
        def __init__(self, fx):
            self.__dict__.update(fx.__dict__)
            self.fx = fx

        def __getattr__(self, name):
            return getattr(self.fx, name)

    same = SelfObserved(fx01)
    same.observed_state = fx01.desired_state.select(
        "message_id", F.reverse("categories").alias("categories"), "flag_status", "importance")
    assert sync.state_diff_df(same).count() == 0


def test_batch_request_invariants(fx01):
    b = work.batch_requests(fx01)
    per = b.groupBy("user_upn", "salt", "request_batch").agg(F.count(F.lit(1)).alias("n"),
                                                             F.count_distinct("id").alias("ids"))
    assert per.filter((F.col("n") > 20) | (F.col("n") != F.col("ids"))).count() == 0
    assert b.select("message_id").distinct().count() == b.count()


def test_body_response_round_trip(fx01):
    parsed = parse_body_response(body_responses(fx01.body))
    src = fx01.body.select("message_id", "content", "content_type")
    assert parsed.select("message_id", "content", "content_type").exceptAll(src).count() == 0


def test_work_batches_remainder_goes_last(fx01):
    b = {r["batch_number"]: r["n_items"] for r in work.work_batches(fx01, 3).collect()}
    assert sum(b.values()) == 500 and b[1] == b[2] == 166 and b[3] == 168


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and "feature" in df.columns


def test_apply_publish_writes_new_versions(spark, fx001):
    paths = mining.apply_publish(fx001)
    assert set(paths) == {"rules", "metrics", "snapshots"}
    snaps = spark.read.parquet(paths["snapshots"])
    assert snaps.filter(F.col("is_active")).count() == 0          # every active snapshot invalidated
    assert spark.read.parquet(paths["rules"]).count() >= fx001.rule.count()


def test_learned_confidence_edge_rows(spark):  # T24, FIXTURES section 3
    df = spark.createDataFrame([(20, 5, 1), (80, 5, 2), (80, 4, 1), (31, 9, 3)], "conf int, n30 int, n int")
    got = [r[0] for r in df.select(sync.learned_confidence(F.col("conf"), F.col("n30"), F.col("n"))).collect()]
    assert got == [30, 70, 80, 30]


def test_strict_mining_uses_matcher_rules(fx01):
    """strict=True: a List-ID without <...> is no longer a 'domain' (T1/T2)."""
    loose = mining.feature_rows(fx01).filter(F.col("feature") == "list_domain")
    strict = mining.feature_rows(fx01, strict=True).filter(F.col("feature") == "list_domain")
    assert loose.filter(F.col("key_value").startswith("plain-")).count() > 0
    assert strict.filter(F.col("key_value").startswith("plain-")).count() == 0
    assert strict.count() < loose.count()


def test_overview_approx_close_to_exact(fx01):
    from triage.plans import reports
    exact = {r["primary_category"]: r["n_senders"] for r in reports.category_overview(fx01).collect()}
    approx = {r["primary_category"]: r["n_senders"] for r in reports.category_overview(fx01, approx=True).collect()}
    assert exact.keys() == approx.keys()
    # default relative standard deviation is 5%: allow three of them
    assert all(abs(approx[k] - exact[k]) <= max(2, 0.15 * exact[k]) for k in exact)
