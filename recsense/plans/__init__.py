"""Registered queries: operators applied to whole tables, with their SQL."""

from __future__ import annotations

import importlib
import pkgutil

from . import registry


def _load() -> None:
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")


def queries() -> dict[str, registry.Query]:
    _load()
    return registry.QUERIES


def sql() -> dict[str, str]:
    _load()
    return registry.SQL
