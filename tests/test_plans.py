"""Physical-plan properties of every registered query (what must hold at scale)."""

import re

import pytest

from tests.conftest import SF001

# a nested-loop join is allowed only against a single row
NLJ_ALLOWED = {"process_log_tail"}


def _names():
    from triage.registry import load_all
    return sorted(load_all())


@pytest.fixture(scope="module")
def plans(spark, registry):
    out = {}
    for name, q in registry.items():
        df = q.run(spark, SF001)
        out[name] = df._jdf.queryExecution().executedPlan().toString()
    return out


@pytest.mark.parametrize("name", _names())
def test_no_cartesian_no_python(plans, name):
    p = plans[name]
    assert "CartesianProduct" not in p
    assert not any(x in p for x in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"))
    if name not in NLJ_ALLOWED:
        assert "BroadcastNestedLoopJoin" not in p


def test_scans_prune_columns(plans):
    """The events table has a free-text ``props`` column no job needs: it must never be read."""
    for name, p in plans.items():
        for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", p):
            assert "props" not in schema, name


def test_queries_that_return_no_subjects_read_none(plans):
    for name in ("rules_payload", "rule_listing", "rule_category_features", "rules_after_publish"):
        assert "subject#" not in plans[name], name


def test_no_round_robin_exchange(plans):
    assert not [name for name, p in plans.items() if "RoundRobinPartitioning" in p]


def test_gateway_filters_empty_values_before_its_join(plans):
    p = plans["gateway_decisions"]
    assert "NestedLoop" not in p


def test_no_filter_cleans_text(spark, registry):
    """A filter that Catalyst pushes below a projection repeats its expressions, the whole cleaning chain at worst."""
    for name in ("content_duplicates", "clean_plain", "clean_html", "text_metrics", "fetch_outcome"):
        p = registry[name].run(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in p.splitlines() if re.search(r"[-+] Filter|^Filter", x) and "regexp_replace" in x], name


def test_no_filter_makes_addresses_again(spark, registry):
    """A null check pushed below the projections of the match features evaluates them again, nested, for every mail."""
    for name in ("gateway_decisions", "gateway_daily_share", "match_coverage"):
        p = registry[name].run(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in re.split(r"\n(?=[ :]*[-+])", p) if re.search(r"^[ :]*[-+]+ *Filter", x) and "regexp_" in x], name
