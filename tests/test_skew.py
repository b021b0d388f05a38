"""A hot key holding a third of all mail: results stay whole and equal to brute force."""

from functools import cached_property

import pytest
from pyspark.sql import functions as F

from triage.plans import gateway as gw
from triage.plans import mining, reports
from triage.sources.fixtures import Fixtures
from tests.conftest import SF01, rows

HOT = "hot.example.com"


class HotFixtures(Fixtures):
    """The sf0.01 fixtures with every third mail sent from one domain and one address."""

    @cached_property
    def mail(self):
        m = super().mail
        hot = F.col("message_id").substr(5, 10).cast("long") % 3 == 0
        return (m.withColumn("from_domain", F.when(hot, F.lit(HOT)).otherwise(F.col("from_domain")))
                .withColumn("from_address", F.when(hot, F.lit("News+x@" + HOT)).otherwise(F.col("from_address"))))


@pytest.fixture(scope="module")
def hot(spark):
    return HotFixtures(spark, SF01)


def test_hot_key_really_is_hot(hot):
    n = hot.mail.count()
    h = hot.mail.filter(F.col("from_domain") == HOT).count()
    assert 0.3 < h / n < 0.35


def test_mining_with_hot_key_equals_literal_join(spark, hot):
    mining.feature_rows(hot).createOrReplaceTempView("hot_features")
    literal = spark.sql("""
      select feature, key_value, count(*) as support, count(distinct primary_category) as n_cat,
        min(decided_at) as first_seen, max(decided_at) as last_seen
      from hot_features group by feature, key_value""")
    lean = mining.rule_metrics(hot).select(
        "feature", "key_value", F.col("support").cast("bigint"), F.col("distinct_categories").cast("bigint"),
        "first_seen", "last_seen")
    assert rows(literal) == rows(lean)
    top = mining.rule_metrics(hot).filter((F.col("feature") == "from_domain") & (F.col("key_value") == HOT)).first()
    assert top is not None and top["support"] > 3000


def test_gateway_with_hot_key_one_row_per_mail(hot):
    g = gw.gateway(hot.mail, hot.list_entry, hot.rule)
    assert g.count() == hot.mail.count() == g.select("message_id").distinct().count()


def test_reports_with_hot_key_are_whole(hot):
    """The distinct senders of the hot domain come back as rows, all of them."""
    cd = reports.category_domains(hot)
    lab = reports.labelled(hot, "industry_news")
    want = lab.filter(F.col("from_domain") == HOT).select("from_address").distinct().count()
    got = cd.filter(F.col("from_domain") == HOT).filter(F.col("sender").isNotNull()).count()
    assert got == want
