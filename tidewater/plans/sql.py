"""ANSI SQL (DuckDB dialect) equal in meaning to the registered Spark queries.

Used as the correctness oracle: the same rows, the same column names, plain types
(BIGINT, DOUBLE, VARCHAR, TIMESTAMP).  Every text starts from the ``sensors`` projection
of the ``events`` table (``tidewater.fixtures.sensors_sql``).
"""

from __future__ import annotations

from .. import schemas as S
from ..fixtures import sensors_sql
from ..operators.forecast import Z_95

SILVER_COLS = ("Id, MeasurementDateTime, CAST(SensorValue AS DOUBLE) AS SensorValue, "
               "SensorUnitDescription, SensorMeasurement, SensorLocation")


def with_sensors(body: str, hourly: bool = False, extra_ctes: str = "") -> str:
    ctes = f"sensors AS ({sensors_sql(hourly)})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


def ma_columns(frames: dict[str, int], partition: str = "", order: str = "MeasurementDateTime, Id") -> str:
    cols = []
    for name, k in frames.items():
        w = f"({partition} ORDER BY {order} ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"
        cols.append(f"round(CAST(SUM(SensorValue) OVER {w} AS DOUBLE) / COUNT(SensorValue) OVER {w}, 6) AS {name}")
    return ",\n  ".join(cols)


def ma_select(frames: dict[str, int], where: str = "", partition: str = "", source: str = "sensors") -> str:
    return (f"SELECT {SILVER_COLS},\n  {ma_columns(frames, partition)}\nFROM {source}"
            + (f"\nWHERE {where}" if where else ""))


def forecast_ctes(source: str = "sensors", train_filter: bool = False) -> str:
    """CTEs ``series, span, params, season`` (fit on all history, or on all but the last
    24 hours when ``train_filter``)."""
    series = (f"series AS (SELECT date_trunc('hour', MeasurementDateTime) AS ds, SensorMeasurement AS ts_id, "
              f"CAST(SUM(SensorValue) AS DOUBLE) / COUNT(SensorValue) AS y FROM {source} GROUP BY 1, 2)")
    if train_filter:
        train = ("fullspan AS (SELECT ts_id, MAX(ds) AS end_time FROM series GROUP BY 1),\n"
                 "train AS (SELECT s.* FROM series s JOIN fullspan f USING (ts_id) WHERE s.ds <= f.end_time - INTERVAL 24 HOUR),\n"
                 "test AS (SELECT s.* FROM series s JOIN fullspan f USING (ts_id) WHERE s.ds > f.end_time - INTERVAL 24 HOUR)")
        src = "train"
    else:
        train, src = "", "series"
    parts = [series]
    if train:
        parts.append(train)
    parts += [
        f"span AS (SELECT ts_id, MIN(ds) AS start_time, MAX(ds) AS end_time FROM {src} GROUP BY 1)",
        f"st AS (SELECT s.*, span.start_time, (epoch(s.ds) - epoch(span.start_time)) / 3600.0 AS t "
        f"FROM {src} s JOIN span USING (ts_id))",
        "trend AS (SELECT ts_id, COALESCE(regr_intercept(y, t), AVG(y)) AS intercept, "
        "COALESCE(regr_slope(y, t), 0.0) AS slope FROM st GROUP BY 1)",
        "rr AS (SELECT st.*, y - (intercept + slope * t) AS r, hour(ds) AS hr FROM st JOIN trend USING (ts_id))",
        "season AS (SELECT ts_id, hr, AVG(r) AS season FROM rr GROUP BY 1, 2)",
        "sigma AS (SELECT ts_id, COALESCE(stddev_samp(rr.r - season.season), 0.0) AS sigma "
        "FROM rr JOIN season USING (ts_id, hr) GROUP BY 1)",
        "params AS (SELECT * FROM span JOIN trend USING (ts_id) JOIN sigma USING (ts_id))",
    ]
    return ",\n".join(parts)


def predict_sql(frame: str) -> str:
    """yhat/band for rows (ts_id, ds, ...) of ``frame``."""
    return (f"SELECT f.*, p.intercept + p.slope * (epoch(f.ds) - epoch(p.start_time)) / 3600.0 "
            f"+ COALESCE(se.season, 0.0) AS yhat, p.sigma FROM {frame} f JOIN params p USING (ts_id) "
            f"LEFT JOIN season se ON se.ts_id = f.ts_id AND se.hr = hour(f.ds)")


def forecast_future_sql() -> str:
    future = ("future AS (SELECT p.ts_id, (SELECT MAX(end_time) FROM span) + g.h * INTERVAL 1 HOUR AS ds "
              "FROM params p, range(1, 25) AS g(h))")
    return (forecast_ctes() + ",\n" + future + f",\npred AS ({predict_sql('future')})\n")


def forecast_rows_sql() -> str:
    """Rows: SensorMeasurement, ds, yhat, yhat_lower, yhat_upper (unrounded, as CTE body)."""
    return (f"SELECT ts_id AS SensorMeasurement, ds, yhat, yhat - {Z_95!r} * sigma AS yhat_lower, "
            f"yhat + {Z_95!r} * sigma AS yhat_upper FROM pred")


def metrics_sql() -> str:
    return (forecast_ctes(train_filter=True) + ",\n"
            f"scored AS ({predict_sql('test')}),\n"
            f"sc AS (SELECT ts_id, y, yhat, yhat - {Z_95!r} * sigma AS lo, yhat + {Z_95!r} * sigma AS hi FROM scored)\n")


METRICS_SELECT = """SELECT ts_id,
  round(AVG((y - yhat) * (y - yhat)), 6) AS mse,
  round(sqrt(AVG((y - yhat) * (y - yhat))), 6) AS rmse,
  round(AVG(abs(y - yhat)), 6) AS mae,
  round(AVG(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END), 6) AS mape,
  round(median(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END), 6) AS mdape,
  round(AVG(CASE WHEN abs(y) + abs(yhat) > 0 THEN 2.0 * abs(y - yhat) / (abs(y) + abs(yhat)) END), 6) AS smape,
  round(AVG(CASE WHEN y >= lo AND y <= hi THEN 1.0 ELSE 0.0 END), 6) AS coverage
FROM sc GROUP BY ts_id"""


def water_quality_forecast_ctes() -> str:
    """CTEs ending in ``water_quality_forecast`` (the overlay view)."""
    ma = ma_select({"WaterTempShortMovingAverage": 30, "WaterTempLongMovingAverage": 365},
                   where=f"SensorMeasurement = '{S.WATER_QUALITY}'")
    return (forecast_future_sql().rstrip() + f""",
fc AS ({forecast_rows_sql()}),
smoothed AS ({ma}),
overlay AS (
  SELECT ds AS MeasurementDateTime, 'forecast' AS ValueType, yhat AS SensorValue FROM fc WHERE SensorMeasurement = '{S.WATER_QUALITY}'
  UNION
  SELECT MeasurementDateTime, 'actuals', WaterTempShortMovingAverage FROM smoothed),
water_quality_forecast AS (
  SELECT * FROM overlay WHERE SensorValue >= 0 ORDER BY MeasurementDateTime DESC, ValueType, SensorValue LIMIT 1000)""")


def _daily_ctes(verified: dict[str, str]) -> str:
    """CTEs of the daily statistics: a reading counts once for every reading of a verified sensor at its time, and
    the ids of those are counted per day."""
    sensors = ", ".join(f"'{m}'" for m in verified.values())
    return f"""matches AS (
  SELECT SensorMeasurement, MeasurementDateTime, COUNT(*) AS n FROM sensors WHERE SensorMeasurement IN ({sensors}) GROUP BY ALL),
weighed AS (
  SELECT SensorLocation, SensorMeasurement, MeasurementDateTime, date_trunc('day', MeasurementDateTime) AS MDate, SensorValue,
         coalesce(n, 1) AS times FROM sensors LEFT JOIN matches USING (SensorMeasurement, MeasurementDateTime)),
daily AS (
  SELECT SensorLocation, SensorMeasurement, MDate, MIN(SensorValue) AS lo, MAX(SensorValue) AS hi, COUNT(*) AS readings,
         CAST(SUM(SensorValue) AS DOUBLE) / COUNT(SensorValue) AS mean_reading, CAST(SUM(times) AS BIGINT) AS matched,
         CAST(SUM(SensorValue * times) AS DOUBLE) / SUM(CASE WHEN SensorValue IS NOT NULL THEN times END) AS mean_matched
  FROM weighed GROUP BY ALL),
places AS (SELECT DISTINCT SensorLocation, SensorMeasurement, MDate, MeasurementDateTime FROM weighed),
ids AS (
  SELECT p.SensorLocation, p.SensorMeasurement, p.MDate, COUNT(DISTINCT v.Id) AS n FROM places p
  JOIN sensors v ON v.SensorMeasurement = p.SensorMeasurement AND v.MeasurementDateTime = p.MeasurementDateTime
  WHERE p.SensorMeasurement IN ({sensors}) GROUP BY ALL)"""


def _id_counts(verified: dict[str, str]) -> str:
    return ", ".join(f"CASE WHEN d.SensorMeasurement = '{m}' THEN coalesce(ids.n, 0) ELSE 0 END AS {c}" for c, m in verified.items())


def gold_daily_sql(verified: dict[str, str], hourly: bool = False) -> str:
    """Daily statistics with the forecast of the day; readings count once per match."""
    ctes = water_quality_forecast_ctes() + ",\n" + _daily_ctes(verified) + """,
ahead AS (SELECT date_trunc('day', MeasurementDateTime) AS MDate, AVG(SensorValue) AS mean_ahead FROM water_quality_forecast GROUP BY 1)"""
    return with_sensors(f"""SELECT d.SensorLocation, d.MDate, d.SensorMeasurement, d.matched AS RecordsInDay, {_id_counts(verified)},
  CAST(lo AS DOUBLE) AS Lowest, round(mean_matched, 6) AS Midpoint, CAST(hi AS DOUBLE) AS Highest,
  CASE WHEN a.MDate IS NULL THEN 0 ELSE 1 END AS HasForecast, round(mean_ahead, 6) AS AvgDailyForecast
FROM daily d LEFT JOIN ids USING (SensorLocation, SensorMeasurement, MDate)
LEFT JOIN ahead a ON a.MDate = d.MDate AND d.SensorMeasurement = '{S.WATER_QUALITY}'""", hourly=hourly, extra_ctes=ctes)


def gold_daily_verified_sql(verified: dict[str, str], hourly: bool = True) -> str:
    """The same per reading: every reading counts once, without a forecast."""
    return with_sensors(f"""SELECT d.SensorLocation, d.MDate, d.SensorMeasurement, readings AS RecordsInDay, {_id_counts(verified)},
  CAST(lo AS DOUBLE) AS Lowest, round(mean_reading, 6) AS Midpoint, CAST(hi AS DOUBLE) AS Highest,
  0 AS HasForecast, CAST(NULL AS DOUBLE) AS AvgDailyForecast
FROM daily d LEFT JOIN ids USING (SensorLocation, SensorMeasurement, MDate)""", hourly=hourly, extra_ctes=_daily_ctes(verified))


def cut_sql(i: int, parts: int = 3, col: str = "MeasurementDateTime", table: str = "sensors") -> str:
    """The i-th of the times that cut a table's span into equal parts, in whole microseconds."""
    return f"(SELECT make_timestamp(MIN(epoch_us({col})) + (MAX(epoch_us({col})) - MIN(epoch_us({col}))) * {i} // {parts}) FROM {table})"
