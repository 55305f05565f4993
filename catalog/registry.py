"""The named queries and their SQL, filled in by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.sql import with_views
from catalog.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None, *names: str):
    """Register a function of :class:`Views` under its own name; ``names`` are the SQL views it reads."""

    def register(function: Callable[[Views], DataFrame]):
        QUERIES[function.__name__] = lambda spark, folder: function(Views(spark, folder))
        if sql is not None:
            CHECKS[function.__name__] = with_views(sql, *names)
        return function

    return register
