"""Sensor-shaped views over the driver's test tables.

``sensors`` maps the ``events`` table onto the silver sensor schema; every oracle SQL
starts from the same projection (``SENSORS_SQL``), so Spark and DuckDB see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S

# Fixed mapping of event types to sensor measurements and units.
EVENT_TO_MEASUREMENT = {
    "view": S.WATER_QUALITY,
    "click": S.WATER_TEMP,
    "purchase": S.AIR_TEMP,
    "signup": S.WATER_PH,
    "error": S.WATER_DEPTH_FEET,
}
MEASUREMENT_UNIT = {
    S.WATER_QUALITY: "index",
    S.WATER_TEMP: "degrees",
    S.AIR_TEMP: "degrees",
    S.WATER_PH: "pH",
    S.WATER_DEPTH_FEET: "feet",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col, mapping: dict[str, str]):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def sensors_from_events(events: DataFrame, hourly: bool = False, with_payload: bool = False,
                        with_user: bool = False) -> DataFrame:
    """events -> silver sensor rows (Id, MeasurementDateTime, SensorValue, unit,
    measurement, location). ``hourly`` truncates time to the hour (ties, join fan-out)."""
    ts = F.col("ts")
    if hourly:
        ts = F.date_trunc("hour", ts).cast("timestamp_ntz")
    measurement = _case(F.col("event_type"), EVENT_TO_MEASUREMENT).otherwise(F.lit(S.WATER_DEPTH_FEET))
    cols = [
        F.col("event_id").alias("Id"),
        ts.alias("MeasurementDateTime"),
        F.col("value").cast("decimal(18,2)").alias("SensorValue"),
        measurement.alias("SensorMeasurement"),
        F.concat(F.lit("site_"), (F.col("user_id") % 2).cast("string")).alias("SensorLocation"),
    ]
    if with_payload:
        cols.append(F.col("props").alias("payload"))
    if with_user:
        cols.append(F.col("user_id"))
    df = events.select(*cols)
    unit = _case(F.col("SensorMeasurement"), MEASUREMENT_UNIT)
    return df.withColumn("SensorUnitDescription", unit)


def sensors(spark: SparkSession, sf_dir: str, hourly: bool = False, **kw) -> DataFrame:
    return sensors_from_events(table(spark, sf_dir, "events"), hourly=hourly, **kw)


def route(df: DataFrame, measurement: str) -> DataFrame:
    return df.filter(F.col("SensorMeasurement") == F.lit(measurement))


def _case_sql(col: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE '{default}' END"


def sensors_sql(hourly: bool = False, source: str = "events") -> str:
    """DuckDB/ANSI projection equal to ``sensors_from_events`` (for oracle CTEs)."""
    ts = "date_trunc('hour', ts)" if hourly else "ts"
    m = _case_sql("event_type", EVENT_TO_MEASUREMENT, S.WATER_DEPTH_FEET)
    unit_whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MEASUREMENT_UNIT.items())
    return (f"SELECT event_id AS Id, CAST({ts} AS TIMESTAMP) AS MeasurementDateTime, "
            f"CAST(value AS DECIMAL(18,2)) AS SensorValue, {m} AS SensorMeasurement, "
            f"'site_' || CAST(user_id % 2 AS VARCHAR) AS SensorLocation, "
            f"CASE {m} {unit_whens} END AS SensorUnitDescription, props AS payload, user_id "
            f"FROM {source}")


def sensors_cte(name: str = "sensors", hourly: bool = False) -> str:
    return f"{name} AS ({sensors_sql(hourly)})"


def series_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem as a second, larger sensor series (bench): one series per return flag."""
    return lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("Id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("MeasurementDateTime"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("SensorValue"),
        F.col("l_returnflag").alias("SensorMeasurement"),
        F.lit("warehouse").alias("SensorLocation"),
    )
