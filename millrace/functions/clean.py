"""Cleaning and formatting column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import TS_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_alarm(alarm: Column | str) -> Column:
    """'' becomes 'None'; null stays null."""
    return F.when(_col(alarm) == "", "None").otherwise(_col(alarm))


def denorm_alarm(alarm: Column | str) -> Column:
    """The published form: 'None' and null become ''."""
    return F.when(_col(alarm).isNull() | (_col(alarm) == "None"), "").otherwise(_col(alarm))


def is_failure(status: str = "machine_status", alarm: str = "alarm_code") -> Column:
    """Three-valued: Running with a null alarm is unknown (not kept), Error with one is a failure."""
    quiet = F.col(alarm) == "None"
    return ~(((F.col(status) == "Idle") & quiet) | ((F.col(status) == "Running") & quiet))


def machine_no(name: Column | str) -> Column:
    """'Machine_10' gives 10; a name without a number gives null."""
    return F.substring_index(_col(name), "_", -1).try_cast("int")


def parse_ts(text: Column | str) -> Column:
    return F.try_to_timestamp(_col(text), F.lit(TS_FORMAT))


def format_ts(ts: Column | str) -> Column:
    return F.date_format(_col(ts), TS_FORMAT)


def iso_week(ts: Column | str) -> Column:
    """ISO year and week such as '2025-W01'."""
    week = F.lpad(F.extract(F.lit("WEEK"), _col(ts)).cast("string"), 2, "0")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), _col(ts)).cast("string"), F.lit("-W"), week)


def period(ts: Column | str, grain: str) -> Column:
    """Label of the day, ISO week or month a time falls in."""
    if grain == "day":
        return F.to_date(_col(ts))
    if grain == "week":
        return iso_week(ts)
    if grain == "month":
        return F.date_format(_col(ts), "yyyy-MM")
    raise ValueError(f"unknown grain {grain!r}")


def has_all(required: Sequence[str]) -> Column:
    present = F.lit(True)
    for c in required:
        present = present & F.col(c).isNotNull()
    return present


def missing_fields(required: Sequence[str]) -> Column:
    """Names of the required fields that are null, in the given order."""
    names = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    return F.filter(F.array(*names), lambda name: name.isNotNull())


def with_key(rows: DataFrame, key: str = "machine_id") -> DataFrame:
    """Rows that name a machine."""
    return rows.where(F.col(key).isNotNull() & (F.col(key) != ""))


def split_numeric(rows: DataFrame, text_columns: Sequence[str]) -> DataFrame:
    """Cast text to double and add ``is_corrupt``: true when a given text is no number."""
    out, corrupt = rows, F.lit(False)
    for c in text_columns:
        number = F.col(c).try_cast("double")
        corrupt = corrupt | (F.col(c).isNotNull() & number.isNull())
    out = out.withColumn("is_corrupt", corrupt)
    return out.withColumns({c: F.col(c).try_cast("double") for c in text_columns})


def gauge_level(value: Column | str, red_from: float) -> Column:
    return F.when(_col(value) >= red_from, "red").when(_col(value).isNotNull(), "green")


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))
