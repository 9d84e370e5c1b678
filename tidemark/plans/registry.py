"""All driver queries of the library, each registered beside its oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

MODULES = ("series", "weighted", "ingest", "payloads", "textevents", "composites", "features", "streams")


def query(name: str, sql: str | None = None):
    """Register a driver query and, where SQL can express it, its oracle."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


for _module in MODULES:
    importlib.import_module(f"tidemark.plans.{_module}")
