"""Registered batch queries: ``name -> (spark, sf_dir) -> DataFrame``, each
paired (where SQL can express it) with an independent DuckDB oracle query.

Every query reads the driver's tables (through the fixture derivations) and
runs over all of their rows.  Output money is ``double`` (summed exactly as
decimals first); integer columns are ``bigint``; times are text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from emporia.plans import q_orders, q_marts, q_ingest, q_dau, q_serve, q_streams, q_sinks, q_dims  # noqa: F401
