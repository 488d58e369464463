"""Registered queries: one Spark plan per inventory key plus its DuckDB oracle SQL."""

from quiver.plans.registry import REGISTRY, all_plans  # noqa: F401
