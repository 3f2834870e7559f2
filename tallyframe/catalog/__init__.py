"""Every operator over the given tables, with equivalent SQL for checking."""

from importlib import import_module

from tallyframe.catalog.registry import ORACLES, QUERIES

for _part in ("cleaning", "profiling", "features", "validation", "log", "series", "models", "storage", "streams"):
    import_module(f"tallyframe.catalog.{_part}")

__all__ = ["ORACLES", "QUERIES"]
