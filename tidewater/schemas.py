"""Schemas, route configuration and fixed literals of the sensor pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These literals must equal the ones the pipeline is fed with.
# Sensor measurement names, in the order the bronze fan-out lists them:
#   average_temperature, h2o_quality, h2o_pH, h2o_temperature, h2o_depth
# The message-queue variant and the gold benchmark call water depth h2o_feet.
# ---------------------------------------------------------------------------
AIR_TEMP = "average_temperature"
WATER_QUALITY = "h2o_quality"
WATER_PH = "h2o_pH"
WATER_TEMP = "h2o_temperature"
WATER_DEPTH = "h2o_depth"
WATER_DEPTH_FEET = "h2o_feet"

# route name -> SensorMeasurement literal (one bronze/silver table per route)
DEFAULT_ROUTES: dict[str, str] = {
    "air_temp": AIR_TEMP,
    "water_quality": WATER_QUALITY,
    "water_ph": WATER_PH,
    "water_temp": WATER_TEMP,
    "water_depth": WATER_DEPTH_FEET,
}

# Columns of the raw export that carry no information after cleaning.
RAW_DROP_COLUMNS = ["Skip", "SkipResult", "SkipTable",
                    "WindowAverageStartDateTime", "WindowAverageStopDateTime"]

MEASURES = ["MeasurementDateTime", "SensorValue", "SensorUnitDescription",
            "SensorMeasurement", "SensorLocation"]


def value_type(reference_precision: bool = False) -> T.DecimalType:
    """Decimal type of SensorValue.

    ``DecimalType()`` in the original notebooks is DECIMAL(10,0) and rounds 7.6 to 8;
    the default here keeps two decimals, ``reference_precision=True`` gives (10,0).
    """
    return T.DecimalType(10, 0) if reference_precision else T.DecimalType(18, 2)


def raw_sensor_schema(reference_precision: bool = False, window_as_string: bool = False) -> T.StructType:
    """The 11 positional columns of the raw sensor CSV export."""
    win = T.StringType() if window_as_string else T.TimestampType()
    return T.StructType([
        T.StructField("Skip", T.StringType()),
        T.StructField("SkipResult", T.StringType()),
        T.StructField("SkipTable", T.StringType()),
        T.StructField("WindowAverageStartDateTime", win),
        T.StructField("WindowAverageStopDateTime", win),
        T.StructField("MeasurementDateTime", T.TimestampType()),
        T.StructField("SensorValue", value_type(reference_precision)),
        T.StructField("SensorUnitDescription", T.StringType()),
        T.StructField("SensorMeasurement", T.StringType()),
        T.StructField("SensorLocation", T.StringType()),
        T.StructField("Id", T.StringType()),
    ])


def silver_schema(reference_precision: bool = False, float_value: bool = False) -> T.StructType:
    vt = T.FloatType() if float_value else value_type(reference_precision)
    return T.StructType([
        T.StructField("MeasurementDateTime", T.TimestampType()),
        T.StructField("SensorValue", vt),
        T.StructField("SensorUnitDescription", T.StringType()),
        T.StructField("SensorMeasurement", T.StringType()),
        T.StructField("SensorLocation", T.StringType()),
        T.StructField("Id", T.StringType(), False),
    ])
