"""All queries of the reference's own operators with their oracles, gathered from lodestone.plans."""

from __future__ import annotations

import importlib
import pkgutil

from lodestone import plans


def _modules():
    return [importlib.import_module(f"lodestone.plans.{m.name}") for m in pkgutil.iter_modules(plans.__path__)]


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _modules() for k, v in m.ORACLES.items()}
