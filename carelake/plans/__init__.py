"""Registered queries over the driver tables, each beside its reference SQL."""

from __future__ import annotations

import importlib

MODULES = ("scalars", "tables", "exploring", "joining", "indicators", "features", "loading", "streams")


def all_queries() -> tuple[dict, dict]:
    from carelake.plans import roles

    for module in MODULES:
        importlib.import_module(f"carelake.plans.{module}")
    return roles.QUERIES, roles.ORACLES
