"""Every operator as a named query over the given tables, next to the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans.fixtures import Tables
from riskloom.plans.registry.core import REGISTERED

_SECTIONS = ["mapping", "history", "relational", "models", "monitoring", "operations"]


def _load() -> None:
    for section in _SECTIONS:
        import_module(f"{__name__}.{section}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {
        name: (lambda spark, folder, run=entry.run: run(Tables(spark, folder)))
        for name, entry in REGISTERED.items()
    }


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: entry.sql for name, entry in REGISTERED.items() if entry.sql}
