"""Dimension tables: id and name of machines, states, alarms; operator ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace import schemas

DIMENSIONS = {
    "machines": ("machine_no int, machine_name string", schemas.MACHINES),
    "machine_status": ("status_id int, status_name string", schemas.MACHINE_STATUS),
    "alarm_codes": ("alarm_id int, alarm_name string", schemas.ALARM_CODES),
    "operators": ("operator_no int", schemas.OPERATORS),
}


def seed(spark: SparkSession, name: str) -> DataFrame:
    """The seed rows as a literal table (VALUES list): its size is fixed by the code."""
    ddl, rows = DIMENSIONS[name]
    columns = [field.split()[0] for field in ddl.split(", ")]
    values = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS seed({', '.join(columns)})")


def read_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A dimension file with a header line; the reader drops a byte order mark."""
    ddl, _ = DIMENSIONS[name]
    return spark.read.schema(ddl).option("header", True).option("enforceSchema", True).csv(path)


def copy(dimension: DataFrame, path: str) -> None:
    dimension.coalesce(1).write.mode("overwrite").parquet(path)
