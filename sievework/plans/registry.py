"""Queries over the driver tables by name, each with the SQL that reproduces it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("search", "store", "ranking", "quotas", "similar", "captions", "states", "planning", "learning", "streams", "files")
_loaded = False


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; ``sql`` is its equivalent over the same tables, none where SQL cannot express it."""

    def add(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is there already")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load_all() -> None:
    global _loaded
    if not _loaded:
        for m in _MODULES:
            importlib.import_module(f"sievework.plans.{m}")
        _loaded = True


def queries() -> dict[str, Query]:
    _load_all()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load_all()
    return _SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["f01_caption_search"](spark, sf_dir)
