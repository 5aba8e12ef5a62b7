"""Silver -> gold: moving-average tables, the forecast overlay view and the daily gold
aggregate of the benchmark suite."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.timewin import day
from ..operators import forecast as fc
from ..operators.moving_average import moving_average
from ..session import materialize

# Output names of the gold tables.
AIR_FRAMES = {"TempShortMovingAverage": 30, "TempLongMovingAverage": 365}
WATER_FRAMES = {"WaterTempShortMovingAverage": 30, "WaterTempLongMovingAverage": 365}
# verified-count column -> sensor literal of the per-sensor silver table joined for it
VERIFIED_COLUMNS = {
    "CountOfVerifiedWaterDepthRecords": S.WATER_DEPTH_FEET,
    "CountOfVerifiedWaterQualityRecords": S.WATER_QUALITY,
    "CountOfVerifiedWaterTempRecords": S.WATER_TEMP,
    "CountOfVerifiedAirTempRecords": S.AIR_TEMP,
}


def ma_table(silver: DataFrame, measurement: str | None, frames: Mapping[str, int],
             partition_by=(), **kw) -> DataFrame:
    """``SELECT *, avg(v) OVER (ORDER BY ts ROWS k PRECEDING) ...`` on one sensor
    (filter pushed to the scan) or on a per-sensor table (``measurement=None``)."""
    src = silver if measurement is None else silver.filter(F.col("SensorMeasurement") == F.lit(measurement))
    return moving_average(src, frames=frames, partition_by=partition_by, **kw)


def water_quality_forecast(gold_water_quality: DataFrame, forecast_rows: DataFrame,
                           measurement: str = S.WATER_QUALITY, limit: int = 1000) -> DataFrame:
    """Latest ``limit`` points of actual short moving average UNION forecast,
    non-negative values only.  The limit is the view's feature (a top-k report)."""
    forecast_part = (forecast_rows.filter(F.col("SensorMeasurement") == F.lit(measurement))
                     .select(F.col("ds").alias("MeasurementDateTime"), F.lit("forecast").alias("ValueType"),
                             F.col("yhat").cast("double").alias("SensorValue")))
    actual_part = gold_water_quality.select(
        "MeasurementDateTime", F.lit("actuals").alias("ValueType"),
        F.col("WaterTempShortMovingAverage").cast("double").alias("SensorValue"))
    combined = actual_part.unionByName(forecast_part).distinct()
    return (combined.filter(F.col("SensorValue") >= 0)
                    .orderBy(F.col("MeasurementDateTime").desc(), "ValueType", "SensorValue").limit(limit))


_day = day   # F1: date_trunc('day', ts) as a zone-less timestamp


def gold_daily(silver: DataFrame, verified: Mapping[str, tuple[str, DataFrame]],
               forecast_view: DataFrame | None, forecast_measurement: str = S.WATER_QUALITY,
               keep_join_fanout: bool = True) -> DataFrame:
    """Daily min/max/avg per (location, measurement) with verified-id counts.

    The benchmark statement left-joins the silver rows to four per-sensor tables on the
    timestamp (with a literal on the left side only) and aggregates the joined rows, so
    RecordsInDay and Midpoint count a reading once per matching right row.
    ``keep_join_fanout=True`` returns exactly those numbers, ``False`` the per-reading
    ones.

    No joined pair is ever made. Silver is reduced to one row per (location, measurement, time) and the right tables
    to one per (measurement, time, id), each read once. A distinct id of a day that stands at one time only is
    counted at that time, as a number that every location with a reading then adds up. Ids that stand at several
    times of a day are grouped into classes with the same times; a class is looked up through one of its ids and
    counted once per location.

    ``verified``: output column -> (sensor literal, per-sensor table with MeasurementDateTime, Id).
    """
    lits = [m for m, _ in verified.values()]
    if len(set(lits)) != len(lits):
        raise ValueError("each verified table needs its own sensor literal")
    L, M, TS, V = "SensorLocation", "SensorMeasurement", "MeasurementDateTime", "SensorValue"
    v, date = F.col(V), _day(F.col(TS)).alias("MDate")
    base = silver.groupBy(L, M, TS).agg(F.count(F.lit(1)).alias("_rows"), F.sum(v).alias("_sum"), F.count(v).alias("_values"), F.min(v).alias("_low"), F.max(v).alias("_high"))
    base = materialize(base, "daily-readings")
    rights = None
    for lit, right in verified.values():
        r = right.select(F.lit(lit).alias(M), TS, "Id")
        rights = r if rights is None else rights.unionByName(r)
    rights = materialize(rights.filter(F.col(TS).isNotNull()).groupBy(M, TS, "Id").agg(F.count(F.lit(1)).alias("_c")), "daily-ids")

    mix = lambda seed: F.bit_xor(F.xxhash64(TS, F.lit(seed)))
    of_id = rights.filter(F.col("Id").isNotNull()).groupBy(M, date, "Id").agg(F.count(F.lit(1)).alias("_times"), F.min(TS).alias(TS), mix(1).alias("_h1"), mix(2).alias("_h2"))
    alone = of_id.filter("_times = 1").groupBy(M, TS).agg(F.count(F.lit(1)).alias("_ids"))
    at_time = rights.groupBy(M, TS).agg(F.sum("_c").alias("_c")).join(alone, [M, TS], "left")
    s = base.join(at_time, [M, TS], "left")
    fan = F.coalesce(F.col("_c"), F.lit(1)).cast("long") if keep_join_fanout else F.lit(1).cast("long")
    r1 = s.groupBy(L, M, date).agg(
        F.min("_low").cast("double").alias("Lowest"),
        F.max("_high").cast("double").alias("Highest"),
        F.round(F.try_divide(F.sum(F.col("_sum") * fan).cast("double"), F.sum(F.col("_values") * fan).cast("double")), 6).alias("Midpoint"),
        F.sum(F.col("_rows") * fan).alias("RecordsInDay"),
        F.sum(F.coalesce("_ids", F.lit(0))).alias("_alone"))

    # ids at several times of a day: classes of equal times, each with the times of its smallest id
    classes = of_id.filter("_times > 1").groupBy(M, "MDate", "_times", "_h1", "_h2").agg(F.min("Id").alias("Id"), F.count(F.lit(1)).alias("_ids"))
    times = rights.select(M, TS, date, "Id").join(classes.select(M, "MDate", "Id", "_ids"), [M, "MDate", "Id"])
    seen = base.select(L, M, TS).join(times, [M, TS]).groupBy(L, M, "MDate", "Id").agg(F.max("_ids").alias("_ids"))
    several = seen.groupBy(L, M, "MDate").agg(F.sum("_ids").alias("_several"))
    keys = [L, M, "MDate"]
    r1 = r1.alias("a").join(several.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "left").select("a.*", "_several")
    ids = F.col("_alone") + F.coalesce("_several", F.lit(0))
    for col, lit in ((c, m) for c, (m, _) in verified.items()):
        r1 = r1.withColumn(col, F.when(F.col(M) == F.lit(lit), ids).otherwise(F.lit(0)).cast("long"))
    r1 = r1.drop("_alone", "_several")

    if forecast_view is not None:
        # one row per forecast day; the view is a top-k, so this side is bounded
        fday = (forecast_view.groupBy(_day(F.col(TS)).alias("MDate"))
                .agg(F.max("ValueType").isNotNull().alias("_has"),
                     F.round(F.avg(F.col(V).cast("double")), 6).alias("AvgDailyForecast"))
                .withColumn(M, F.lit(forecast_measurement)))
        r1 = r1.join(F.broadcast(fday), ["MDate", M], "left")
        r1 = r1.withColumn("HasForecast", F.when(F.col("_has"), F.lit(1)).otherwise(F.lit(0))).drop("_has")
    else:
        r1 = r1.withColumn("HasForecast", F.lit(0)).withColumn("AvgDailyForecast", F.lit(None).cast("double"))
    return r1.select(L, "MDate", M, "RecordsInDay", *verified.keys(), "Lowest", "Midpoint", "Highest",
                     "HasForecast", "AvgDailyForecast")


def silver_hourly_forecast(silver: DataFrame) -> DataFrame:
    """FCST: hourly series per sensor -> 24 forecast hours (ds, SensorMeasurement, yhat...)."""
    series = fc.hourly_series(silver)
    out = fc.forecast(series)
    return out.withColumnRenamed("ts_id", "SensorMeasurement")
