"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.tables import Tables

Build = Callable[[Tables], DataFrame]

_BUILDS: dict[str, Build] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register a function of the tables under its own name."""

    def register(build: Build) -> Build:
        name = build.__name__
        if name in _BUILDS:
            raise ValueError(f"query {name} is already registered")
        _BUILDS[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def runnable() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Build) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Tables(spark, folder))

    return {name: bind(build) for name, build in _BUILDS.items()}


def oracles() -> dict[str, str]:
    return dict(_SQL)
