"""All registered queries and their oracle texts."""

from __future__ import annotations

from millrace.plans import (  # noqa: F401  (importing a module registers its queries)
    aggregating,
    databases,
    files,
    filtering,
    incidents,
    joining,
    layouts,
    nested,
    projecting,
    quarantine,
    retail,
    zones,
)
from millrace.plans.registry import oracles, runnable


def queries():
    return runnable()


def oracle_sql():
    return oracles()
