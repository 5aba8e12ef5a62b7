"""Searched per-series forecast (U3-U5, U9, T4): penalised additive model, distributed.

Model per series: ``y/scale = X beta + e`` with X = [1, trend, K trend hinges, daily and
weekly Fourier terms] (Prophet-style design, cf. Taylor & Letham 2018), hinge and
seasonal coefficients ridge-penalised by ``1/changepoint_prior_scale^2`` and
``1/seasonality_prior_scale^2``; ``multiplicative`` seasonality scales the seasonal terms
with the trend level.  The fit needs only the sufficient statistics X'X, X'y, y'y, n:

1. ``mapInPandas`` turns each partition's rows into partial statistics per
   (series, CV segment) - numpy, one small matrix per group present in the partition;
2. partials are summed per series with ``applyInPandas`` (a group holds at most
   partitions x segments small rows, never the series' readings) and the penalised
   normal equations are solved for every (trial, fold) - rolling-origin folds are nested,
   so fold statistics are prefix sums over segments;
3. hold-out rows are scored against all trials with a join on (series, fold) and a
   vectorised ``mapInPandas``; metrics are Spark aggregates; the best trial per series
   is a ``min_by`` on smape.

Nothing is collected to the driver; a series of any length is spread over all tasks.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .forecast import HORIZON, INTERVAL_WIDTH, METRICS, Z_95, metrics

# Fixed values of the search (mirroring the original search space and CV settings):
# changepoint_prior_scale  log-uniform exp(-6.9) .. exp(-0.69)
# seasonality_prior_scale  log-uniform exp(-6.9) .. exp(2.3)
# holidays_prior_scale     log-uniform exp(-6.9) .. exp(2.3)
# seasonality_mode         additive | multiplicative
# 10 trials, 5 rolling-origin folds, horizon 24 hours, metric smape, interval 0.95
SEARCH_SPACE = {"changepoint_prior_scale": (-6.9, -0.69), "seasonality_prior_scale": (-6.9, 2.3),
                "holidays_prior_scale": (-6.9, 2.3)}
SEASONALITY_MODES = ("additive", "multiplicative")
MAX_EVALS = 10
NUM_FOLDS = 5
FOLD_PERIOD_HOURS = HORIZON // 2
N_CHANGEPOINTS = 10
CHANGEPOINT_RANGE = 0.8
DAILY_ORDER = 3
WEEKLY_ORDER = 2
N_FEATURES = 2 + N_CHANGEPOINTS + 2 * DAILY_ORDER + 2 * WEEKLY_ORDER
FULL_FOLD = -1  # the fit on all history


def _halton(i: int, base: int) -> float:
    f, r = 1.0, 0.0
    while i > 0:
        f /= base
        r += f * (i % base)
        i //= base
    return r


def trials(n: int = MAX_EVALS) -> list[dict]:
    """Deterministic quasi-random (Halton) sample of the search space."""
    out = []
    for i in range(1, n + 1):
        p = {}
        for j, (name, (lo, hi)) in enumerate(SEARCH_SPACE.items()):
            p[name] = round(math.exp(lo + (hi - lo) * _halton(i, (2, 3, 5)[j])), 6)
        p["seasonality_mode"] = SEASONALITY_MODES[i % 2]
        out.append(p)
    return out


def trials_frame(spark, n: int = MAX_EVALS) -> DataFrame:
    rows = [(i, json.dumps(p, sort_keys=True), p["changepoint_prior_scale"], p["seasonality_prior_scale"],
             p["seasonality_mode"]) for i, p in enumerate(trials(n))]
    return spark.createDataFrame(rows, "trial int, prophet_params string, cps double, sps double, mode string")


def design(t_hours: np.ndarray, abs_hours: np.ndarray, span: np.ndarray, mode: str) -> np.ndarray:
    """Design matrix rows for hours since start, absolute epoch hours and series span."""
    tn = t_hours / np.maximum(span, 1.0)
    cols = [np.ones_like(tn), tn]
    for j in range(1, N_CHANGEPOINTS + 1):
        c = CHANGEPOINT_RANGE * j / (N_CHANGEPOINTS + 1)
        cols.append(np.maximum(0.0, tn - c))
    seas = []
    for k in range(1, DAILY_ORDER + 1):
        a = 2 * np.pi * k * np.mod(abs_hours, 24.0) / 24.0
        seas += [np.sin(a), np.cos(a)]
    for k in range(1, WEEKLY_ORDER + 1):
        a = 2 * np.pi * k * np.mod(abs_hours, 168.0) / 168.0
        seas += [np.sin(a), np.cos(a)]
    if mode == "multiplicative":
        seas = [s * (1.0 + tn) for s in seas]
    return np.column_stack(cols + seas)


def _penalty(cps: float, sps: float) -> np.ndarray:
    d = np.zeros(N_FEATURES)
    d[2:2 + N_CHANGEPOINTS] = 1.0 / cps ** 2
    d[2 + N_CHANGEPOINTS:] = 1.0 / sps ** 2
    return d * 1e-3


def prepare(series: DataFrame, key: str = "ts_id", horizon: int = HORIZON, folds: int = NUM_FOLDS) -> DataFrame:
    """Rows (key, ds, y) + per-series constants and the CV segment of each row.
    segment s = number of fold cutoffs before ds (0 .. folds); fold f trains on
    segments <= folds-1-f and is scored on (cutoff_f, cutoff_f + horizon]."""
    span = series.groupBy(key).agg(F.min("ds").alias("_start"), F.max("ds").alias("_end"),
                                   F.max(F.abs("y")).alias("_scale"))
    s = series.join(span, key)
    hours = lambda c: F.unix_seconds(F.col(c).cast("timestamp")) / F.lit(3600.0)
    s = s.withColumns({"t": hours("ds") - hours("_start"), "abs_h": hours("ds"),
                       "span": hours("_end") - hours("_start"),
                       "scale": F.when(F.col("_scale") > 0, F.col("_scale")).otherwise(F.lit(1.0))})
    # cutoff_f = end - horizon - f * period (f = 0 newest)
    seg = F.lit(0)
    for f in range(folds):
        cut = F.col("span") - F.lit(horizon + f * FOLD_PERIOD_HOURS)
        seg = seg + F.when(F.col("t") > cut, 1).otherwise(0)
    return s.withColumn("seg", seg.cast("int")).select(key, "ds", "y", "t", "abs_h", "span", "scale", "seg", "_start")


STATS_SCHEMA = T.StructType([
    T.StructField("ts_id", T.StringType()), T.StructField("seg", T.IntegerType()), T.StructField("mode", T.StringType()),
    T.StructField("n", T.LongType()), T.StructField("yty", T.DoubleType()),
    T.StructField("xty", T.ArrayType(T.DoubleType())), T.StructField("xtx", T.ArrayType(T.DoubleType())),
])


def _partial_stats(batches):
    acc = {}
    for pdf in batches:
        if pdf.empty:
            continue
        for mode in SEASONALITY_MODES:
            X = design(pdf["t"].to_numpy(float), pdf["abs_h"].to_numpy(float), pdf["span"].to_numpy(float), mode)
            y = pdf["y"].to_numpy(float) / pdf["scale"].to_numpy(float)
            for (sid, seg), idx in pdf.groupby(["ts_id", "seg"]).indices.items():
                Xi, yi = X[idx], y[idx]
                k = (sid, int(seg), mode)
                a = acc.get(k)
                part = (len(idx), float(yi @ yi), Xi.T @ yi, Xi.T @ Xi)
                acc[k] = part if a is None else (a[0] + part[0], a[1] + part[1], a[2] + part[2], a[3] + part[3])
    if acc:
        yield pd.DataFrame([{"ts_id": k[0], "seg": k[1], "mode": k[2], "n": v[0], "yty": v[1],
                             "xty": v[2].tolist(), "xtx": v[3].ravel().tolist()} for k, v in acc.items()])


COEF_SCHEMA = T.StructType([
    T.StructField("ts_id", T.StringType()), T.StructField("trial", T.IntegerType()), T.StructField("fold", T.IntegerType()),
    T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType()),
    T.StructField("n_train", T.LongType()), T.StructField("error", T.StringType()),
])


def _solver(trial_rows: list[tuple], folds: int):
    cols = [f.name for f in COEF_SCHEMA.fields]

    def solve_series(pdf: pd.DataFrame, sid: str) -> list[tuple]:
        out = []
        for mode in SEASONALITY_MODES:
            m = pdf[pdf["mode"] == mode]
            segs = {}
            for r in m.itertuples():
                n, yty, xty, xtx = segs.get(r.seg, (0, 0.0, np.zeros(N_FEATURES), np.zeros((N_FEATURES, N_FEATURES))))
                segs[r.seg] = (n + r.n, yty + r.yty, xty + np.asarray(r.xty),
                               xtx + np.asarray(r.xtx).reshape(N_FEATURES, N_FEATURES))
            for fold in [FULL_FOLD, *range(folds)]:
                last = folds if fold == FULL_FOLD else folds - 1 - fold
                parts = [v for s, v in segs.items() if s <= last]
                if not parts:
                    continue
                n = sum(p[0] for p in parts)
                yty = sum(p[1] for p in parts)
                xty = sum(p[2] for p in parts)
                xtx = sum(p[3] for p in parts)
                for trial, cps, sps, tmode in trial_rows:
                    if tmode != mode:
                        continue
                    A = xtx + np.diag(_penalty(cps, sps)) + 1e-9 * np.eye(N_FEATURES)
                    beta = np.linalg.solve(A, xty)
                    rss = max(yty - 2 * beta @ xty + beta @ xtx @ beta, 0.0)
                    sigma = math.sqrt(rss / max(n - N_FEATURES, 1))
                    if not (np.all(np.isfinite(beta)) and math.isfinite(sigma)):
                        raise FloatingPointError("non-finite fit (missing or infinite values in the series)")
                    out.append((sid, trial, fold, beta.tolist(), sigma, n, None))
        return out

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        # U4: a series whose fit fails yields one error row instead of failing the job
        sid = pdf["ts_id"].iloc[0]
        try:
            rows = solve_series(pdf, sid)
        except Exception as e:  # noqa: BLE001 - any failure of one series is reported, not raised
            rows = [(sid, None, None, None, None, None, f"{type(e).__name__}: {e}")]
        return pd.DataFrame(rows, columns=cols)
    return solve


def fit_failures(coefs: DataFrame) -> DataFrame:
    """Series whose fit failed, with the error text."""
    return coefs.filter(F.col("error").isNotNull()).select("ts_id", "error")


def fit_all(prepared: DataFrame, n_trials: int = MAX_EVALS, folds: int = NUM_FOLDS) -> DataFrame:
    """Coefficients and residual sigma (scaled units) per (series, trial, fold)."""
    stats = prepared.mapInPandas(_partial_stats, STATS_SCHEMA)
    trial_rows = [(i, p["changepoint_prior_scale"], p["seasonality_prior_scale"], p["seasonality_mode"])
                  for i, p in enumerate(trials(n_trials))]
    return stats.groupBy("ts_id").applyInPandas(_solver(trial_rows, folds), COEF_SCHEMA)


SCORED_SCHEMA = "ts_id string, trial int, fold int, ds timestamp_ntz, y double, yhat double, yhat_lower double, yhat_upper double"


def _score(z: float):
    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            res = []
            for mode in SEASONALITY_MODES:
                m = pdf[pdf["mode"] == mode]
                if m.empty:
                    continue
                X = design(m["t"].to_numpy(float), m["abs_h"].to_numpy(float), m["span"].to_numpy(float), mode)
                B = np.vstack(m["coef"].to_numpy())
                scale = m["scale"].to_numpy(float)
                yhat = np.einsum("ij,ij->i", X, B) * scale
                band = z * m["sigma"].to_numpy(float) * scale
                res.append(pd.DataFrame({"ts_id": m["ts_id"], "trial": m["trial"], "fold": m["fold"], "ds": m["ds"],
                                         "y": m["y"], "yhat": yhat, "yhat_lower": yhat - band, "yhat_upper": yhat + band}))
            if res:
                yield pd.concat(res)
    return run


def score(rows: DataFrame, coefs: DataFrame, trial_df: DataFrame, z: float = Z_95) -> DataFrame:
    """yhat and band for rows (ts_id, fold, ds, y?, t, abs_h, span, scale) under every trial."""
    j = rows.join(coefs, ["ts_id", "fold"]).join(F.broadcast(trial_df.select("trial", "mode")), "trial")
    return j.mapInPandas(_score(z), SCORED_SCHEMA)


def cross_validate(series: DataFrame, spark, n_trials: int = MAX_EVALS, folds: int = NUM_FOLDS,
                   horizon: int = HORIZON) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (metrics per series and trial, coefficients, prepared rows)."""
    # the prepared hourly rows feed the statistics, every fold's hold-out and the spans
    prep = materialize(prepare(series, "ts_id", horizon, folds), "ridge-prepared")
    tdf = trials_frame(spark, n_trials)
    coefs = materialize(fit_all(prep, n_trials, folds).filter(F.col("error").isNull()), "ridge-coefs")  # scored, and the final models
    # hold-out rows of fold f: segment folds-f (rows after cutoff_f) within horizon of cutoff_f
    holdout = None
    for f in range(folds):
        cut = F.col("span") - F.lit(horizon + f * FOLD_PERIOD_HOURS)
        part = prep.filter((F.col("t") > cut) & (F.col("t") <= cut + F.lit(horizon))).withColumn("fold", F.lit(f))
        holdout = part if holdout is None else holdout.unionByName(part)
    scored = score(holdout, coefs, tdf)
    m = metrics(scored.withColumn("key", F.struct("ts_id", "trial")), key="key")
    return m.select("key.ts_id", "key.trial", *METRICS), coefs, prep


def best_models(spark, series: DataFrame, n_trials: int = MAX_EVALS, folds: int = NUM_FOLDS,
                horizon: int = HORIZON) -> DataFrame:
    """Per series the trial with the lowest mean smape, as a FORECAST_RESULT
    row (model_json holds the full-history coefficients and scaling)."""
    m, coefs, prep = cross_validate(series, spark, n_trials, folds, horizon)
    best = m.groupBy("ts_id").agg(F.min_by(F.struct(*[F.col(c) for c in ("trial", *METRICS)]),
                                           F.struct(F.col("smape"), F.col("trial"))).alias("b"))
    best = best.select("ts_id", *[F.col(f"b.{c}").alias(c) for c in ("trial", *METRICS)])
    span = prep.groupBy("ts_id").agg(F.min("_start").alias("start_time"), F.max("ds").alias("end_time"),
                                     F.max("span").alias("span"), F.max("scale").alias("scale"))
    full = coefs.filter(F.col("fold") == FULL_FOLD).drop("fold")
    tdf = trials_frame(spark, n_trials)
    out = best.join(full, ["ts_id", "trial"]).join(span, "ts_id").join(F.broadcast(tdf), "trial")
    model = F.to_json(F.struct(F.col("coef"), F.col("sigma"), F.col("scale"), F.col("span"), F.col("mode"),
                               F.col("start_time").cast("string").alias("start_time"),
                               F.lit(INTERVAL_WIDTH).alias("interval_width")))
    return out.select(F.col("ts_id").alias("SensorMeasurement"), model.alias("model_json"), "prophet_params",
                      "start_time", "end_time", *[F.col(c).cast("float").alias(c) for c in METRICS])


def predict_future(models: DataFrame, horizon: int = HORIZON, z: float = Z_95) -> DataFrame:
    """``horizon`` hourly steps after the latest history time of all series,
    scored from model_json (the served model is just this column)."""
    schema = "coef array<double>, sigma double, scale double, span double, mode string, start_time string"
    m = models.select("SensorMeasurement", F.from_json("model_json", schema).alias("m"), "end_time")
    m = m.withColumn("_end", models.agg(F.max("end_time")).scalar())   # scalar subquery
    steps = m.select("SensorMeasurement", "m", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"), "_end")
    ds = (F.col("_end") + F.make_dt_interval(hours=F.col("h"))).cast("timestamp_ntz")
    hrs = lambda c: F.unix_seconds(c.cast("timestamp")) / F.lit(3600.0)
    rows = steps.select(F.col("SensorMeasurement").alias("ts_id"), F.lit(FULL_FOLD).alias("fold"), F.lit(0).alias("trial"),
                        ds.alias("ds"), F.lit(None).cast("double").alias("y"),
                        (hrs(ds) - hrs(F.col("m.start_time").cast("timestamp_ntz"))).alias("t"), hrs(ds).alias("abs_h"),
                        F.col("m.span").alias("span"), F.col("m.scale").alias("scale"), F.col("m.coef").alias("coef"),
                        F.col("m.sigma").alias("sigma"), F.col("m.mode").alias("mode"))
    out = rows.mapInPandas(_score(z), SCORED_SCHEMA)
    return out.select(F.col("ts_id").alias("SensorMeasurement"), "ds", "yhat", "yhat_lower", "yhat_upper")
