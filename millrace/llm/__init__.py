"""Operators of a training-data pipeline; nothing else in the library imports this subpackage."""

from __future__ import annotations


def queries():
    from millrace.llm import checks

    return dict(checks.QUERIES)


def oracle_sql():
    from millrace.llm import checks

    return dict(checks.SQL)
