"""The registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.plans.views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *names: str):
    """Registers a function of v: v(name) is a given or a derived table; names are the derived ones that sql needs."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: view(spark, sf_dir, name))
        if sql:
            ORACLES[f.__name__] = with_views(sql.strip(), *names) if names else sql
        return f

    return add


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)
