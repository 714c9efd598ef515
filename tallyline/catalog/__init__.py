"""Every operator as a query over the given tables."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("state", "quality", "content", "io")


def _load():
    for name in _MODULES:
        import_module(f"tallyline.catalog.{name}")
    return import_module("tallyline.catalog.registry")


def queries() -> dict:
    """Query name -> callable (spark, sf_dir)."""
    return dict(_load().QUERIES)


def oracles() -> dict:
    """Query name -> SQL for DuckDB."""
    return dict(_load().ORACLES)
