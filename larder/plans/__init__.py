from __future__ import annotations

from importlib import import_module

MODULES = ["relational", "modeling", "streams", "checked"]


def load_queries() -> None:
    """Import the modules that register queries."""
    for name in MODULES:
        import_module(f"larder.plans.{name}")
