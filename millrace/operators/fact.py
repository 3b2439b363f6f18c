"""The fused fact table: sensor rows with their nearest production and power rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import clean
from millrace.operators.asof import Feed, nearest_within


def mes_feed(mes: DataFrame, tie: str = "event_id") -> Feed:
    return Feed("mes", mes, schemas.MES_TOLERANCE_S, schemas.MES_COLUMNS, tie)


def scada_feed(scada: DataFrame, tie: str = "event_id") -> Feed:
    return Feed("scada", scada, schemas.SCADA_TOLERANCE_S, schemas.SCADA_COLUMNS, tie)


def fuse(
    iot: DataFrame, mes: DataFrame | None = None, scada: DataFrame | None = None, require_mes: bool = False,
    tie: str = "event_id",
) -> DataFrame:
    """Sensor rows with the columns of the feeds given; a report may leave out a feed it never reads."""
    feeds = []
    if mes is not None:
        feeds.append(mes_feed(mes, tie))
    if scada is not None:
        feeds.append(scada_feed(scada, tie))
    fused = nearest_within(iot, feeds, ["machine_id"], required=["mes"] if require_mes else [])
    if scada is not None:
        fused = fused.withColumn("alarm_code", clean.norm_alarm("alarm_code"))
    return fused


def enrich(fused: DataFrame, machine_status: DataFrame, alarm_codes: DataFrame) -> DataFrame:
    """Add state and alarm ids (null if the name is unknown) and reduce the machine name to its number.

    The dimension tables are joined without a hint: they are far below the broadcast threshold,
    which Spark checks against their real size.
    """
    named = fused.join(machine_status, F.col("machine_status") == F.col("status_name"), "left")
    named = named.join(alarm_codes, F.col("alarm_code") == F.col("alarm_name"), "left")
    computed = {
        "machine_id": clean.machine_no("machine_id"),
        "operator_id": F.col("operator_id").cast("string"),
        "machine_status_id": F.col("status_id"),
        "machine_status": F.col("status_name"),
    }
    return named.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in schemas.FACT_COLUMNS])


def resolve_iot(iot: DataFrame, machines: DataFrame) -> DataFrame:
    """Replace the machine name by its number; rows of unknown machines drop."""
    joined = iot.join(machines, F.col("machine_id") == F.col("machine_name"))
    return joined.select("ts", *schemas.IOT_COLUMNS, "machine_no")


def resolve_mes(mes: DataFrame, machines: DataFrame, operators: DataFrame) -> DataFrame:
    """As ``resolve_iot``; the operator may come as text and must be known too."""
    joined = mes.withColumn("_operator", F.col("operator_id").try_cast("int"))
    joined = joined.join(operators, F.col("_operator") == F.col("operator_no"))
    joined = joined.join(machines, F.col("machine_id") == F.col("machine_name"))
    return joined.select(
        "ts", "operator_no", "units_produced", "defective_units", "production_time_min", "machine_no"
    )


def resolve_scada(scada: DataFrame, machines: DataFrame, machine_status: DataFrame, alarm_codes: DataFrame) -> DataFrame:
    joined = scada.join(machines, F.col("machine_id") == F.col("machine_name"))
    joined = joined.join(alarm_codes, F.col("alarm_code") == F.col("alarm_name"))
    joined = joined.join(machine_status, F.col("machine_status") == F.col("status_name"))
    return joined.select("ts", "power_kw", "machine_no", "alarm_id", "status_id")


def only_new(rows: DataFrame, existing: DataFrame, key: tuple[str, ...] = ("ts", "machine_id")) -> DataFrame:
    """Rows whose key the table does not hold yet."""
    return rows.join(existing.select(*key), list(key), "left_anti")
