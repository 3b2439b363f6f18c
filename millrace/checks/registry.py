"""Where the check queries register."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.checks.sql import over
from millrace.operators import align
from millrace.session import prepare
from millrace.sources import events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None, ctes: Sequence[str] = (), doubles: str = "", digits: int = 6, recursive: bool = False):
    """Register a query with its SQL; columns named in ``doubles`` are rounded on the SQL side."""
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return align.rounded(build(prepare(spark), folder), digits)

        QUERIES[name] = run
        if sql is not None:
            body = sql
            if doubles:
                changed = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in doubles.split())
                body = f"SELECT * REPLACE ({changed}) FROM ({sql})"
            SQL[name] = over(body, *ctes, recursive=recursive)
        return build

    return register


def feed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return events.feed(spark, folder, name)


def feeds(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """iot, scada, mes"""
    rows = events.read_events(spark, folder)
    return events.iot(rows), events.scada(rows), events.mes(rows)


def hourly(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    iot, scada, mes = feeds(spark, folder)
    return events.hourly(iot), events.hourly(scada), events.hourly(mes)


def all_topics(spark: SparkSession, folder: str) -> DataFrame:
    iot, scada, mes = feeds(spark, folder)
    return events.by_topic({"iot": iot, "scada": scada, "mes": mes})
