"""All queries of the forecast engine, and the SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forelight.plans import catalogue, forecast, grids, observations, operations, scenarios

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _plan in (forecast, observations, scenarios, operations, catalogue, grids):
    QUERIES |= _plan.QUERIES
    ORACLES |= _plan.ORACLES
