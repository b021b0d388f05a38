"""Named query registry: name -> (Spark query, DuckDB oracle SQL or None).

Plan modules register their queries with ``@register``. A query function receives a
``Fixtures`` object (lazy fixture views over one scale-factor folder) and returns a lazy
DataFrame; nothing is collected.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from triage.sources.fixtures import Fixtures, with_fixtures

PLAN_MODULES = (
    "triage.plans.reports",
    "triage.plans.mining",
    "triage.plans.incremental",
    "triage.plans.composite",
    "triage.plans.gateway",
    "triage.plans.audit",
    "triage.plans.text",
    "triage.plans.work",
    "triage.plans.sync",
    "triage.plans.rules",
    "triage.plans.versions",
    "triage.plans.snapshots",
    "triage.plans.surface",
    "triage.plans.stored",
    "triage.plans.ingest",
    "triage.plans.constraints",
    "triage.streaming.batch_twins",
)


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[Fixtures], DataFrame]
    sql: str | None
    ops: str

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.fn(Fixtures(spark, sf_dir))


_REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, uses: str = "", ops: str = ""):
    def deco(fn):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        _REGISTRY[name] = Query(name, fn, with_fixtures(sql, uses) if sql else None, ops)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    for m in PLAN_MODULES:
        importlib.import_module(m)
    return dict(_REGISTRY)
