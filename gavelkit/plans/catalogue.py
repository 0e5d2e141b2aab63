"""All registered queries."""

from __future__ import annotations

import importlib

_MODULES = ["market", "stores", "texts", "pages", "pairs", "extraction", "digests", "streams", "intake"]


def _collect(attribute: str) -> dict:
    out: dict = {}
    for name in _MODULES:
        module = importlib.import_module(f"gavelkit.plans.{name}")
        found = getattr(module, attribute)
        twice = out.keys() & found.keys()
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        out.update(found)
    return out


def all_queries() -> dict:
    return _collect("QUERIES")


def all_oracles() -> dict:
    return _collect("ORACLES")
