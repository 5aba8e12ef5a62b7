"""Aggregations: sensor totals (A1/A2), time-window aggregates (X2/X3) and session
windows (X4).  All are hash aggregates with map-side partial aggregation, so a hot
(location, measurement) group is combined before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.timewin import window_columns
from . import clean

SENSOR_KEYS = ("SensorLocation", "SensorMeasurement")


def sensor_stats(value: str = "SensorValue", id_col: str = "Id") -> list[Column]:
    """avg, count(Id), max, min of a reading - the gold statistics.  The mean is the exact
    decimal sum divided as double (same digits as the SQL oracle)."""
    v = F.col(value)
    return [
        F.round(F.try_divide(F.sum(v).cast("double"), F.count(v).cast("double")), 6).alias("AvgSensorValue"),
        F.count(F.col(id_col)).alias("NumMeasurements"),
        F.max(v).alias("HighestSensorValue"),
        F.min(v).alias("LowestSensorValue"),
    ]


def sensor_totals(df: DataFrame, keys: Sequence[str] = SENSOR_KEYS) -> DataFrame:
    """All-time statistics per (location, measurement)."""
    return df.groupBy(*keys).agg(*sensor_stats())


def window_stats(df: DataFrame, size: str = "10 minutes", slide: str | None = "5 minutes",
                 time_col: str = "MeasurementDateTime", keys: Sequence[str] = SENSOR_KEYS) -> DataFrame:
    """Statistics per (keys, time window); sliding when ``slide`` is given,
    tumbling otherwise.  Columns window_start/window_end instead of the struct."""
    w = F.window(F.col(time_col), size, slide) if slide else F.window(F.col(time_col), size)
    out = df.groupBy(*keys, w.alias("window")).agg(*sensor_stats())
    return out.select(*keys, *window_columns("window"), *[c for c in out.columns if c not in (*keys, "window")])


def session_stats(df: DataFrame, gap: str = "30 minutes", time_col: str = "MeasurementDateTime",
                  keys: Sequence[str] = SENSOR_KEYS, value: str = "SensorValue", id_col: str = "Id") -> DataFrame:
    """Statistics per activity session (a new session starts when more than ``gap``
    passed since the previous reading of the key, as in ``session_window``);
    session_end = last reading + gap.

    Readings in one gap-wide time bucket are always in one session, so they are first
    combined per (keys, bucket) - a partial aggregate before any shuffle - and only the
    bucket rows (their number grows with the time span, not with the reading count) are
    ordered per key to chain buckets into sessions.  A key holding most of the readings
    therefore never sends its readings through one task, unlike ``session_window``
    (``session_stats_builtin``), which sorts every reading of a key in one task."""
    g = F.expr(f"INTERVAL {gap}")
    gap_us = F.unix_micros(F.lit("1970-01-01 00:00:00").cast("timestamp") + g)
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    v = F.col(value)
    buckets = (df.filter(F.col(time_col).isNotNull())
                 .groupBy(*keys, F.floor(t / gap_us).alias("_bk"))
                 .agg(F.min(time_col).alias("_first"), F.max(time_col).alias("_last"),
                      F.sum(v).alias("_sum"), F.count(v).alias("_n"), F.count(F.col(id_col)).alias("_ids"),
                      F.max(v).alias("_max"), F.min(v).alias("_min")))
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy("_bk")
    prev_last = F.lag("_last").over(w)
    # as session_window: readings exactly ``gap`` apart still share a session
    starts = F.when(prev_last.isNull() | (F.col("_first") > prev_last + g), 1).otherwise(0)
    sess = buckets.withColumn("_new", starts).withColumn(
        "_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = sess.groupBy(*keys, "_sid").agg(
        F.min("_first").alias("session_start"), (F.max("_last") + g).alias("session_end"),
        F.round(F.try_divide(F.sum("_sum").cast("double"), F.sum("_n").cast("double")), 6).alias("AvgSensorValue"),
        F.sum("_ids").alias("NumMeasurements"), F.max("_max").alias("HighestSensorValue"),
        F.min("_min").alias("LowestSensorValue"))
    return out.drop("_sid")


def session_stats_builtin(df: DataFrame, gap: str = "30 minutes", time_col: str = "MeasurementDateTime",
                          keys: Sequence[str] = SENSOR_KEYS) -> DataFrame:
    """X4 with Spark's ``session_window`` (the form for streaming queries)."""
    out = df.groupBy(*keys, F.session_window(F.col(time_col), gap).alias("session")).agg(*sensor_stats())
    return out.select(*keys, F.col("session.start").alias("session_start"),
                      F.col("session.end").alias("session_end"),
                      *[c for c in out.columns if c not in (*keys, "session")])
