"""Registry of query plans.

Each entry maps an inventory key to ``fn(spark, sf_dir) -> DataFrame`` and, where
the result is deterministic, the equivalent DuckDB SQL over the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Plan:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is the oracle (None = rows-only check)."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate plan {name}")
        REGISTRY[name] = Plan(name, fn, sql)
        return fn

    return deco


PLAN_MODULES = ("playlists", "purchases", "profiles", "features", "metrics_plans", "vectors",
                "annotations", "recs_plans", "experiments_plans", "text_plans", "learning_plans",
                "sources_plans", "names_plans")


def all_plans() -> dict[str, Plan]:
    """Import every plan module (which fills REGISTRY) and return the registry."""
    import importlib
    import importlib.util

    for m in PLAN_MODULES:
        if importlib.util.find_spec(f"quiver.plans.{m}") is not None:
            importlib.import_module(f"quiver.plans.{m}")
    return REGISTRY
