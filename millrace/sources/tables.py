"""Relational tables over JDBC, read in partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def range_predicates(column: str, bounds: Sequence[str]) -> list[str]:
    """SQL predicates that cut a column at ``bounds`` (increasing) into disjoint, covering ranges.

    Rows whose column is null belong to the first range.
    """
    if not bounds:
        return ["1 = 1"]
    out = [f"{column} < '{bounds[0]}' OR {column} IS NULL"]
    out += [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(bounds, bounds[1:])]
    return [*out, f"{column} >= '{bounds[-1]}'"]


def time_bounds(start: str, end: str, parts: int) -> list[str]:
    """The ``parts`` - 1 inner bounds that cut [start, end) evenly, at whole seconds."""
    import datetime as dt

    first, last = dt.datetime.fromisoformat(start), dt.datetime.fromisoformat(end)
    width = (last - first) / parts
    return [(first + width * i).replace(microsecond=0).isoformat(sep=" ") for i in range(1, parts)]


TEXT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def balanced_bounds(ts: DataFrame, parts: int, accuracy: int = 10_000) -> list[str]:
    """At most ``parts`` - 1 increasing bounds, as text, that cut the one time column of ``ts`` into ranges of about equal counts.

    One pass with a mergeable sketch: a range differs from its share by at most 2 / ``accuracy`` of all rows, unless
    one instant alone has more. Nulls do not count; without times there are no bounds. Read the column by the
    equal widths of ``time_bounds`` first, where days differ much, then the table by these.
    """
    column = F.col(ts.columns[0])
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    cuts = ts.select(F.unix_micros(column.cast("timestamp")).alias("t")).agg(F.percentile_approx("t", shares, accuracy).alias("c"))
    texts = cuts.select(F.explode("c").alias("c")).distinct().orderBy("c").select(F.date_format(F.timestamp_micros("c"), TEXT_TIME))
    return [r[0] for r in texts.collect()]


def parsed_time(rows: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """The time column as a timestamp, and ``is_rejected``: there was a value that is no time (it becomes null)."""
    parsed = F.col(ts).try_cast("timestamp")
    flagged = rows.withColumn("is_rejected", F.col(ts).isNotNull() & parsed.isNull())
    return flagged.withColumn(ts, parsed)


def read_table(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: dict[str, str],
    ts: str = "Timestamp",
) -> DataFrame:
    """One task per predicate instead of one for the table; the time stamp may be stored as text (see ``parsed_time``)."""
    rows = spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    return parsed_time(rows, ts) if ts in rows.columns else rows


def append_table(rows: DataFrame, url: str, table: str, properties: dict[str, str], writers: int | None = None) -> None:
    """Append over JDBC; ``writers`` bounds the connections. A failure is raised, not swallowed."""
    (rows.coalesce(writers) if writers else rows).write.jdbc(url, table, mode="append", properties=properties)


def catalog_settings(name: str, url: str, driver: str, user: str) -> dict[str, str]:
    """Session settings that make a database readable as ``<name>.<schema>.<table>``."""
    prefix = f"spark.sql.catalog.{name}"
    return {
        prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        f"{prefix}.url": url,
        f"{prefix}.driver": driver,
        f"{prefix}.user": user,
    }


def part_of(ts: str, bounds: Sequence[str]) -> Column:
    """Number of the range of ``range_predicates`` a row falls in."""
    part = F.lit(0)
    for i, bound in enumerate(bounds, 1):
        part = F.when(F.col(ts) >= F.lit(bound).cast("timestamp"), F.lit(i)).otherwise(part)
    return part
