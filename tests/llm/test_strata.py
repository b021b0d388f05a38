"""Cutoffs reach the rows by broadcast or by shuffle with the same result."""

from pyspark.sql import functions as F

from tests.conftest import SF01
from triage.llm import quality_rules
from triage.llm.common import table


def test_same_rows_either_way(spark, monkeypatch):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    got = []
    for limit in (8 << 20, 0):
        monkeypatch.setattr(quality_rules, "BROADCAST_BYTES", limit)
        out = quality_rules.apply_rules(docs, labels)
        got.append(sorted(map(str, out.select("doc_id", "kept", F.col("rejected_by").cast("string")).collect())))
    assert got[0] == got[1] and len(got[0]) == 1000
