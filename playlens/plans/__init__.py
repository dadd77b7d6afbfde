"""Registered queries: each pairs a Spark plan over the shared tables with its SQL check."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from playlens.sources.roles import with_roles

Plan = Callable[[SparkSession, str], DataFrame]
PLANS: dict[str, Plan] = {}
CHECKS: dict[str, str] = {}
_FAMILIES = ("basics", "activity", "cohorts", "payments", "attribution", "settlement", "promoters", "finance", "feeds")


_stages: dict[str, DataFrame] = {}


def within_query(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A written table that parts of one query share; the next query writes its own."""
    if name not in _stages:
        _stages[name] = make()
    return _stages[name]


def plan(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def keep(fn: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"query named twice: {name}")

        @wraps(fn)
        def fresh(spark: SparkSession, sf: str) -> DataFrame:
            _stages.clear()
            try:
                return fn(spark, sf)
            finally:
                _stages.clear()

        PLANS[name] = fresh
        if sql:
            CHECKS[name] = with_roles(sql)
        return fn
    return keep


def load_all() -> tuple[dict[str, Plan], dict[str, str]]:
    for family in _FAMILIES:
        importlib.import_module(f"playlens.plans.{family}")
    return PLANS, CHECKS
