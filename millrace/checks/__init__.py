"""Registered queries, each beside the SQL it must agree with."""

from __future__ import annotations

import importlib

MODULES = ("rows", "reports", "models", "streams", "live")


def _load():
    for name in MODULES:
        importlib.import_module(f"millrace.checks.{name}")
    from millrace.checks import registry

    return registry


def queries():
    return dict(_load().QUERIES)


def oracle_sql():
    return dict(_load().SQL)
