"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

import importlib
import pkgutil

from daybook.plans.registry import REGISTERED, Query


def registered() -> dict[str, Query]:
    """All queries by name."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.endswith("_queries")):
        importlib.import_module(f"{__name__}.{module}")
    return REGISTERED
