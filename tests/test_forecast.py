"""Forecast operators against direct numpy computations."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.operators import forecast as fc
from tidewater.operators import ridge

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def series(spark):
    return fc.hourly_series(fx.sensors(spark, SF)).cache()


def test_distributed_ridge_equals_numpy(spark, series):
    prep = ridge.prepare(series, folds=2).repartition(4)
    coefs = ridge.fit_all(prep, n_trials=2, folds=2)
    got = {(r.ts_id, r.trial, r.fold): np.array(r.coef) for r in coefs.collect()}
    pdf = prep.toPandas()
    for i, p in enumerate(ridge.trials(2)):
        for sid, g in pdf.groupby("ts_id"):
            for fold, last in ((ridge.FULL_FOLD, 2), (0, 1), (1, 0)):
                h = g[g["seg"] <= last]
                if h.empty:
                    continue
                X = ridge.design(h["t"].to_numpy(float), h["abs_h"].to_numpy(float), h["span"].to_numpy(float),
                                 p["seasonality_mode"])
                y = h["y"].to_numpy(float) / h["scale"].to_numpy(float)
                A = X.T @ X + np.diag(ridge._penalty(p["changepoint_prior_scale"], p["seasonality_prior_scale"])) \
                    + 1e-9 * np.eye(ridge.N_FEATURES)
                np.testing.assert_allclose(got[(sid, i, fold)], np.linalg.solve(A, X.T @ y), rtol=1e-6, atol=1e-9)


def test_metrics_match_numpy(spark):
    rows = [("a", 1.0, 1.5, 0.0, 2.0), ("a", 2.0, 1.0, 0.5, 1.5), ("a", 0.0, 0.5, 0.0, 1.0), ("b", 4.0, 4.0, 3.0, 5.0)]
    df = spark.createDataFrame(rows, "ts_id string, y double, yhat double, yhat_lower double, yhat_upper double")
    m = {r.ts_id: r for r in fc.metrics(df).collect()}
    y, yh = np.array([1.0, 2.0, 0.0]), np.array([1.5, 1.0, 0.5])
    e = y - yh
    assert m["a"].mse == pytest.approx(np.mean(e ** 2))
    assert m["a"].rmse == pytest.approx(np.sqrt(np.mean(e ** 2)))
    assert m["a"].mae == pytest.approx(np.mean(np.abs(e)))
    assert m["a"].mape == pytest.approx(np.mean(np.abs(e[:2] / y[:2])))
    assert m["a"].mdape == pytest.approx(np.median(np.abs(e[:2] / y[:2])))
    assert m["a"].smape == pytest.approx(np.mean(2 * np.abs(e) / (np.abs(y) + np.abs(yh))))
    assert m["a"].coverage == pytest.approx(2 / 3)
    assert m["b"].coverage == 1.0


def test_future_frame_continues_from_latest_end(spark, series):
    params = fc.fit(series)
    fut = fc.future_frame(params)
    latest = series.agg(F.max("ds")).first()[0]
    r = fut.agg(F.min("ds"), F.max("ds"), F.count(F.lit(1))).first()
    assert (r[0] - latest).total_seconds() == 3600 and (r[1] - latest).total_seconds() == 24 * 3600
    assert r[2] == 24 * series.select("ts_id").distinct().count()


def test_cross_validation_matches_brute_force(spark, series):
    folds, horizon, period = 3, 24, ridge.FOLD_PERIOD_HOURS
    m, _, prep = ridge.cross_validate(series, spark, n_trials=2, folds=folds, horizon=horizon)
    got = {(r.ts_id, r.trial): r.smape for r in m.collect()}
    pdf = prep.toPandas()
    for i, p in enumerate(ridge.trials(2)):
        for sid, g in pdf.groupby("ts_id"):
            ys, yhs = [], []
            for f in range(folds):
                cut = g["span"].iloc[0] - (horizon + f * period)
                tr, te = g[g["t"] <= cut], g[(g["t"] > cut) & (g["t"] <= cut + horizon)]
                if tr.empty or te.empty:
                    continue
                mode = p["seasonality_mode"]
                X = ridge.design(tr["t"].to_numpy(float), tr["abs_h"].to_numpy(float), tr["span"].to_numpy(float), mode)
                y = tr["y"].to_numpy(float) / tr["scale"].to_numpy(float)
                A = X.T @ X + np.diag(ridge._penalty(p["changepoint_prior_scale"], p["seasonality_prior_scale"])) \
                    + 1e-9 * np.eye(ridge.N_FEATURES)
                beta = np.linalg.solve(A, X.T @ y)
                Xt = ridge.design(te["t"].to_numpy(float), te["abs_h"].to_numpy(float), te["span"].to_numpy(float), mode)
                yhs.append(Xt @ beta * te["scale"].to_numpy(float))
                ys.append(te["y"].to_numpy(float))
            if not ys:
                continue
            y, yh = np.concatenate(ys), np.concatenate(yhs)
            den = np.abs(y) + np.abs(yh)
            want = np.mean(2 * np.abs(y - yh)[den > 0] / den[den > 0])
            assert got[(sid, i)] == pytest.approx(want, rel=1e-6), (sid, i)


def test_failing_series_reports_error_row(spark, series):
    bad = series.withColumn("y", F.when((F.col("ts_id") == "h2o_pH") & (F.hour("ds") == 3), F.lit(float("nan")))
                            .otherwise(F.col("y")))
    coefs = ridge.fit_all(ridge.prepare(bad, folds=2), n_trials=2, folds=2)
    fails = {r.ts_id: r.error for r in ridge.fit_failures(coefs).collect()}
    assert list(fails) == ["h2o_pH"] and "non-finite" in fails["h2o_pH"]
    ok = coefs.filter(F.col("error").isNull()).select("ts_id").distinct().count()
    assert ok == series.select("ts_id").distinct().count() - 1
