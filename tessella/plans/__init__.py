"""Query plans, one module for each family of operators."""

from __future__ import annotations

import importlib

FAMILIES = ("joins", "aggregates", "ordered", "geometry", "algebra", "solvers", "streams", "rasters")


def load() -> None:
    """Import every family, which registers its queries."""
    for name in FAMILIES:
        importlib.import_module(f"tessella.plans.{name}")
