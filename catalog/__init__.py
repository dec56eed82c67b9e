"""Registered queries on the driver tables, each with an independent SQL counterpart."""

from __future__ import annotations

from importlib import import_module

from . import registry

TOPICS = (
    "basics", "scalars", "joins", "aggregates", "pos", "online", "reports", "changes", "people",
    "nested", "landed", "rollups",
)


def _load() -> None:
    for topic in TOPICS:
        import_module(f"{__name__}.{topic}")


def all_queries():
    _load()
    return dict(registry.QUERIES)


def all_sql():
    _load()
    return dict(registry.SQL)
