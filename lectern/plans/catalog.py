"""All queries of the library by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import aggregations, checks, filters, imports, inout, inventory, joins, ordering, projections, scalars, state, streams, texts  # noqa: F401
from .registry import ORACLES, QUERIES, complete


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: complete(sql) for name, sql in ORACLES.items()}
