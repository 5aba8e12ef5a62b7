"""Per-series hourly forecasts as Spark jobs.

Model (additive, cf. Taylor & Letham 2018): ``y = a + b*t + s[hour(ds)] + e`` with t in
hours since the series start, a seasonal mean per hour of day, and a normal band from the
residual spread.  Everything follows from sums per (series, hour of day), two-phase
aggregates, so no series is gathered into one task however long it is; the fitted parameters stay a DataFrame (nothing goes through the
driver).  ``tidewater.operators.ridge`` holds the searched, penalised variant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Horizon and unit of the forecast, band width.
HORIZON = 24          # steps
UNIT = "hour"
INTERVAL_WIDTH = 0.95
Z_95 = 1.959963984540054  # two-sided normal quantile for a 0.95 band

METRICS = ("mse", "rmse", "mae", "mape", "mdape", "smape", "coverage")


def hourly_series(silver: DataFrame, time_col: str = "MeasurementDateTime", target: str = "SensorValue",
                  id_cols: Sequence[str] = ("SensorMeasurement",)) -> DataFrame:
    """Mean of the readings per (hour, series): columns ds, id_cols..., y, ts_id."""
    ds = F.date_trunc(UNIT, F.col(time_col)).cast("timestamp_ntz")
    return (silver.groupBy(ds.alias("ds"), *id_cols)
                  .agg((F.sum(F.col(target)).cast("double") / F.count(F.col(target)).cast("double")).alias("y"))
                  .withColumn("ts_id", F.concat_ws("-", *[F.col(c).cast("string") for c in id_cols])))


def _hours(ds, start):
    return (F.unix_seconds(ds.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))) / F.lit(3600.0)


def series_span(series: DataFrame, key: str = "ts_id") -> DataFrame:
    """First and last time of each series."""
    return series.groupBy(key).agg(F.min("ds").alias("start_time"), F.max("ds").alias("end_time"),
                                   F.count(F.lit(1)).alias("n_obs"))


def fit(series: DataFrame, key: str = "ts_id") -> DataFrame:
    """Fit trend + hour-of-day seasonality from sums of one pass over the series: key, start_time, end_time, n_obs,
    intercept, slope, sigma, season (map hour -> mean residual).

    Per (series, hour of day) the sums of y, t, ty, tt and yy are two-phase aggregates; everything else is arithmetic on
    them. t counts hours from the first time of all series, which keeps the sums of squares small."""
    origin = series.agg(F.min("ds")).scalar()
    t = F.when(F.col("y").isNotNull(), _hours(F.col("ds"), origin))
    sums = series.groupBy(key, F.hour("ds").alias("hour")).agg(
        F.min("ds").alias("lo"), F.max("ds").alias("hi"), F.min(_hours(F.col("ds"), origin)).alias("t0"), F.count(F.lit(1)).alias("rows"),
        F.count("y").alias("n"), F.sum("y").alias("y"), F.sum(t).alias("t"), F.sum(t * F.col("y")).alias("ty"),
        F.sum(t * t).alias("tt"), F.sum(F.col("y") * F.col("y")).alias("yy"))
    total = sums.groupBy(key).agg(
        F.min("lo").alias("start_time"), F.max("hi").alias("end_time"), F.min("t0").alias("t0"), F.sum("rows").alias("n_obs"),
        *[F.sum(c).alias(c) for c in ("n", "y", "t", "ty", "tt", "yy")], F.collect_list(F.struct("hour", "n", "y", "t")).alias("hours"))
    n, y, t0 = F.col("n"), F.col("y"), F.col("t0")
    # from here on t counts from the start of the series
    total = total.withColumns({"tt": F.col("tt") - 2 * t0 * F.col("t") + n * t0 * t0, "ty": F.col("ty") - t0 * y, "t": F.col("t") - n * t0})
    t = F.col("t")
    # a single point has no slope: flat trend at the mean
    total = total.withColumn("slope", F.when(n > 1, F.try_divide(F.col("ty") - t * y / n, F.col("tt") - t * t / n)).otherwise(F.lit(0.0)))
    total = total.withColumn("slope", F.coalesce("slope", F.lit(0.0))).withColumn("intercept", (y - F.col("slope") * t) / n)
    a, b = F.col("intercept"), F.col("slope")
    season = F.transform(F.filter("hours", lambda h: h["n"] > 0), lambda h: F.struct(
        h["hour"].alias("hour"), h["n"].alias("n"), ((h["y"] - b * (h["t"] - h["n"] * t0)) / h["n"] - a).alias("season")))
    total = total.withColumn("_season", season)
    residual = F.col("yy") + n * a * a + b * b * F.col("tt") - 2 * a * y - 2 * b * F.col("ty") + 2 * a * b * t
    seasonal = F.aggregate("_season", F.lit(0.0), lambda x, h: x + h["n"] * h["season"] * h["season"])
    sigma = F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (residual - seasonal) / (n - 1)))).otherwise(F.lit(0.0))
    entries = F.transform("_season", lambda h: F.struct(h["hour"], h["season"]))
    return total.select(key, "start_time", "end_time", "n_obs", "intercept", "slope", sigma.alias("sigma"), F.map_from_entries(entries).alias("season"))


def predict(frame: DataFrame, params: DataFrame, key: str = "ts_id", z: float = Z_95) -> DataFrame:
    """yhat and band for every (key, ds) row of ``frame``: one join with the fitted rows."""
    p = frame.join(params.select(key, "start_time", "intercept", "slope", "sigma", "season"), key)
    t = _hours(F.col("ds"), F.col("start_time"))
    season = F.coalesce(F.element_at("season", F.hour("ds")), F.lit(0.0))
    return (p.withColumn("yhat", F.col("intercept") + F.col("slope") * t + season)
             .withColumn("yhat_lower", F.col("yhat") - F.lit(z) * F.col("sigma"))
             .withColumn("yhat_upper", F.col("yhat") + F.lit(z) * F.col("sigma"))
             .drop("start_time", "intercept", "slope", "sigma", "season"))


def future_frame(params: DataFrame, key: str = "ts_id", horizon: int = HORIZON,
                 per_series_end: bool = False) -> DataFrame:
    """``horizon`` hourly steps after the last history time, without history.
    By default all series continue from the latest end over all series (as the
    multi-series model does); ``per_series_end`` uses each series' own end."""
    if per_series_end:
        base = params.select(key, F.col("end_time").alias("_end"))
    else:
        base = params.select(key, params.agg(F.max("end_time")).scalar().alias("_end"))   # scalar subquery
    steps = F.sequence(F.lit(1), F.lit(horizon))
    return (base.select(key, F.explode(steps).alias("_h"), "_end")
                .select(key, (F.col("_end") + F.make_dt_interval(hours=F.col("_h"))).cast("timestamp_ntz").alias("ds")))


def holdout_split(series: DataFrame, key: str = "ts_id", horizon: int = HORIZON) -> tuple[DataFrame, DataFrame]:
    """Hold out the last ``horizon`` hours of each series: (train, test)."""
    span = series_span(series, key).select(key, "end_time")
    cut = F.col("end_time") - F.make_dt_interval(hours=F.lit(horizon))
    s = series.join(span, key)
    return (s.filter(F.col("ds") <= cut).drop("end_time"),
            s.filter(F.col("ds") > cut).drop("end_time"))


def metrics(scored: DataFrame, key: str = "ts_id", y: str = "y") -> DataFrame:
    """Mse rmse mae mape mdape smape coverage per series (native aggregates)."""
    e = F.col(y) - F.col("yhat")
    ape = F.when(F.col(y) != 0, F.abs(e / F.col(y)))
    den = F.abs(F.col(y)) + F.abs(F.col("yhat"))
    m = scored.groupBy(key).agg(
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(ape).alias("mape"),
        F.median(ape).alias("mdape"),
        F.avg(F.when(den > 0, F.lit(2.0) * F.abs(e) / den)).alias("smape"),
        F.avg(F.when((F.col(y) >= F.col("yhat_lower")) & (F.col(y) <= F.col("yhat_upper")), F.lit(1.0))
               .otherwise(F.lit(0.0))).alias("coverage"),
    )
    return m.withColumn("rmse", F.sqrt("mse")).select(key, *METRICS)


def evaluate(series: DataFrame, key: str = "ts_id", horizon: int = HORIZON) -> DataFrame:
    """Fit on all but the last ``horizon`` hours of each series and score the rest.
    The hourly series is materialised once (every step below reads it)."""
    train, test = holdout_split(materialize(series, "hourly-series"), key, horizon)
    return metrics(predict(test, materialize(fit(train, key), "forecast-fit"), key), key)


def forecast(series: DataFrame, key: str = "ts_id", horizon: int = HORIZON) -> DataFrame:
    """Fit on the whole history and forecast ``horizon`` hours ahead. The hourly series and the fitted rows (one
    per series) are written once."""
    params = materialize(fit(materialize(series, "hourly-series"), key), "forecast-fit")
    return predict(future_frame(params, key, horizon), params, key)


def mean_metrics(metric_rows: DataFrame) -> DataFrame:
    """The mean of each metric over all series, named ``val_<metric>``."""
    return metric_rows.agg(*[F.avg(m).alias(f"val_{m}") for m in METRICS])


def series_without_model(series: DataFrame, models: DataFrame, key: str = "ts_id") -> DataFrame:
    """Series with no fitted model (set difference as an anti join)."""
    return series.select(key).distinct().join(models.select(key), key, "left_anti")
