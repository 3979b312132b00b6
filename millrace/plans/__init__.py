"""Queries of the library on the star-schema tables, each with its SQL twin."""

from __future__ import annotations

import importlib

MODULES = ["sources", "scalars", "joins", "aggregates", "windows", "incremental", "penalties", "domain", "contracts", "tender"]


def load_all() -> None:
    """Import every query module so that it registers its queries."""
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
