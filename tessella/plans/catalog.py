"""Where queries are registered under their function's name, with the SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.plans import roles

Query = Callable[[SparkSession, str], DataFrame]
ALL: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None):
    """Register a query under its function's name, with the SQL of the same rows."""

    def add(f: Query) -> Query:
        ALL[f.__name__] = (f, roles.with_roles(sql) if sql else None)
        return f

    return add


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})
