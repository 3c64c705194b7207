"""Registration of queries, and the few helpers their definitions share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.plans.fixtures import Tables, with_views


@dataclass(frozen=True)
class Entry:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTERED: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``views`` are the fixture views its SQL reads."""

    def register(run: Callable[[Tables], DataFrame]):
        if name in REGISTERED:
            raise ValueError(f"{name} is registered twice")
        REGISTERED[name] = Entry(run, with_views(sql, *views) if sql and views else sql)
        return run

    return register


def plain(df: DataFrame, digits: int = 6, *, fine: dict[str, int] | None = None) -> DataFrame:
    """Comparable output: floats rounded, counts as BIGINT, times without zone."""
    fine = fine or {}
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            col = F.round(col.cast("double"), fine.get(f.name, digits))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            col = col.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(f.name))
    return df.select(*out)


def rnd(expr: str, name: str, digits: int = 6) -> str:
    """SQL: rounded, with -0.0 turned into 0.0."""
    return f"round({expr}, {digits}) + 0.0 AS {name}"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def bit(condition: str, name: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS BIGINT) AS {name}"


def json_text(column: Column) -> Column:
    return F.to_json(column)
