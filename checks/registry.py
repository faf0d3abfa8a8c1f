"""Name to query and, where SQL can say the same, name to SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """The frame with the named columns rounded in place."""
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in names else F.col(f"`{c}`")
                       for c in df.columns])


def r(c: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)
