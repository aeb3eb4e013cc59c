"""All registered queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamlab.session import apply_settings
from streamlab.workloads.tables import Tables

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of the tables under its own name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _ORACLES[fn.__name__] = sql
        return fn

    return register


def oracle_of(name: str) -> str | None:
    """The check SQL of another query, for a second form of the same work."""
    return _ORACLES.get(name)


def _load() -> None:
    from streamlab.workloads import batch, files, streams  # noqa: F401


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Tables(apply_settings(spark), sf_dir))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
