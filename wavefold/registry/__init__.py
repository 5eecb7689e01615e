"""Registered queries (Spark) and their DuckDB oracle SQL, keyed by operator."""

from __future__ import annotations

import importlib

_MODULES = [
    "fixed_width_q",
    "panel_q",
    "paths_q",
    "incremental_q",
    "dictionary_q",
    "catalog_q",
    "links_q",
    "files_q",
]


def _load():
    queries, oracle = {}, {}
    for name in _MODULES:
        module = importlib.import_module(f"{__name__}.{name}")
        queries.update(module.QUERIES)
        oracle.update(getattr(module, "ORACLE", {}))
    return queries, oracle


def all_queries():
    return _load()[0]


def all_oracles():
    return _load()[1]
