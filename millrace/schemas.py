"""Declared schemas, names and constants of the three feeds and the fact table."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the messages and files, in their declared order.
IOT_MESSAGE = T.StructType([
    T.StructField("Timestamp", T.StringType()),
    T.StructField("Machine_ID", T.StringType()),
    T.StructField("Temperature_C", T.DoubleType()),
    T.StructField("Vibration_mm_s", T.DoubleType()),
    T.StructField("Pressure_bar", T.DoubleType()),
])
SCADA_MESSAGE = T.StructType([
    T.StructField("Timestamp", T.StringType()),
    T.StructField("Machine_ID", T.StringType()),
    T.StructField("Power_Consumption_kW", T.DoubleType()),
    T.StructField("Machine_Status", T.StringType()),
    T.StructField("Alarm_Code", T.StringType()),
])
MES_MESSAGE = T.StructType([
    T.StructField("Timestamp", T.StringType()),
    T.StructField("Machine_ID", T.StringType()),
    T.StructField("Operator_ID", T.IntegerType()),
    T.StructField("Units_Produced", T.IntegerType()),
    T.StructField("Defective_Units", T.IntegerType()),
    T.StructField("Production_Time_min", T.DoubleType()),
])
MESSAGES = {"iot": IOT_MESSAGE, "scada": SCADA_MESSAGE, "mes": MES_MESSAGE}
TOPICS = {"iot": "iot-data", "scada": "scada-data", "mes": "mes-data"}

# Column of this library for each message field.
COLUMN_OF = {
    "Timestamp": "ts",
    "Machine_ID": "machine_id",
    "Temperature_C": "temperature_c",
    "Vibration_mm_s": "vibration_mm_s",
    "Pressure_bar": "pressure_bar",
    "Power_Consumption_kW": "power_kw",
    "Machine_Status": "machine_status",
    "Alarm_Code": "alarm_code",
    "Operator_ID": "operator_id",
    "Units_Produced": "units_produced",
    "Defective_Units": "defective_units",
    "Production_Time_min": "production_time_min",
}
FIELD_OF = {column: field for field, column in COLUMN_OF.items()}

IOT_COLUMNS = ["temperature_c", "vibration_mm_s", "pressure_bar"]
SCADA_COLUMNS = ["power_kw", "machine_status", "alarm_code"]
MES_COLUMNS = ["operator_id", "units_produced", "defective_units", "production_time_min"]
FEED_COLUMNS = {"iot": IOT_COLUMNS, "scada": SCADA_COLUMNS, "mes": MES_COLUMNS}

FACT_COLUMNS = [
    "ts", "machine_id", "temperature_c", "vibration_mm_s", "pressure_bar", "operator_id", "units_produced",
    "defective_units", "production_time_min", "power_kw", "machine_status_id", "machine_status", "alarm_id",
    "alarm_code",
]

# The dimension tables, at most ten rows each.
MACHINES = [(n, f"Machine_{n}") for n in range(1, 11)]
MACHINE_STATUS = [(1, "Running"), (2, "Idle"), (3, "Error")]
ALARM_CODES = [(1, "None"), (2, "Low Pressure"), (3, "Overheat"), (4, "Vibration High")]
OPERATORS = [(n,) for n in range(1000, 1010)]

MES_TOLERANCE_S = 3600
SCADA_TOLERANCE_S = 900
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
