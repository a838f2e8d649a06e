"""The registered telemetry queries, one for each operator, and the same in DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import basic, ingest, meters, reports, streams, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _module in (basic, windows, meters, reports, ingest, streams):
    QUERIES |= _module.REGISTRY.queries
    ORACLES |= _module.REGISTRY.oracles
