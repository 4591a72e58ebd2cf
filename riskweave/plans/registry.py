"""Queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is any."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


from riskweave.plans import (  # noqa: E402,F401  these register themselves
    analysis_queries,
    climate_queries,
    conflict_queries,
    country_queries,
    detail_queries,
    event_queries,
    panel_queries,
    recipe_queries,
    score_queries,
    source_queries,
    spatial_queries,
    tile_queries,
    track_queries,
    window_queries,
)
