"""Registered queries: operators bound to the given tables, with DuckDB SQL to check them."""

from __future__ import annotations

import importlib

_MODULES = [
    "preparation", "profiles", "ranking", "quality", "sampling", "modeling", "fitted", "outputs"
]


def load():
    """Import all query modules; the queries and their checking SQL."""
    from catalog.registry import ORACLES, QUERIES

    for name in _MODULES:
        importlib.import_module(f"catalog.{name}")
    return dict(QUERIES), dict(ORACLES)
