"""Streams that fail: side by side, at a broken rule; models served by version; daily ids at several times."""
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.operators import quality as q
from tidewater.plans import gold
from tidewater.streaming import multiplex, serving
from tidewater.streaming.runner import run_stream

ROUTES = {"one": "a", "two": "b", "three": "c"}


def _log(spark, path, ids):
    spark.createDataFrame([(i, "abc"[i % 3]) for i in ids], "Id int, kind string").coalesce(1).write.mode("append").parquet(path)


def _start(spark, path, root, broken=(), **kw):
    def read(literal):
        return spark.readStream.schema("Id int, kind string").parquet(path).filter(F.col("kind") == literal)

    def transform(df, name):
        return df.withColumn("Id", F.raise_error(F.lit(f"{name} lost")).cast("int")) if name in broken else df
    return multiplex.start_routes(read, ROUTES, root, transform=transform, **kw)


def _rows(spark, root):
    out = {}
    for n in ROUTES:
        try:
            out[n] = sorted(r.Id for r in spark.read.schema("Id int, kind string").parquet(f"{root}/{n}").collect())
        except PySparkException:
            out[n] = []
    return out


def test_routes_fail_and_catch_up_by_themselves(spark, tmp_path):
    path, root = str(tmp_path / "log"), str(tmp_path / "out")
    _log(spark, path, range(9))
    assert _start(spark, path, root).wait() == {"one": 9, "two": 9, "three": 9}  # every route reads the log by itself
    _log(spark, path, range(9, 18))
    with pytest.raises(multiplex.RoutesFailed) as e:
        _start(spark, path, root, broken=("two",)).wait(stop_on_failure=False)
    assert set(e.value.errors) == {"two"} and "two lost" in str(e.value)
    assert _rows(spark, root) == {"one": list(range(0, 18, 3)), "two": [1, 4, 7], "three": list(range(2, 18, 3))}
    assert _start(spark, path, root).wait()["two"] == 9
    assert _rows(spark, root) == {n: list(range(i, 18, 3)) for i, n in enumerate(ROUTES)}


def test_a_failure_stops_running_routes(spark, tmp_path):
    path, root = str(tmp_path / "log"), str(tmp_path / "out")
    _log(spark, path, range(9))
    running = _start(spark, path, root, broken=("one",), trigger="1 second")  # the others would run for ever
    with pytest.raises(multiplex.RoutesFailed, match="one lost"):
        running.wait()
    assert not any(r.isActive for r in running.queries.values())


def test_a_broken_rule_stops_the_stream_before_its_batch_is_written(spark, tmp_path):
    path, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    read = lambda: spark.readStream.schema("Id int, kind string").parquet(path)
    rules = {"known": "kind IN ('a', 'b', 'c')", "has_id": "Id IS NOT NULL"}
    _log(spark, path, range(3))
    run_stream(q.expect_or_fail(read(), rules), ckpt, path=out)
    spark.createDataFrame([(3, "a"), (4, "z"), (None, "b")], "Id int, kind string").coalesce(1).write.mode("append").parquet(path)
    for _ in range(2):  # it fails as long as the row is there
        with pytest.raises(PySparkException, match="expectation failed"):
            run_stream(q.expect_or_fail(read(), rules), ckpt, path=out)
        assert spark.read.parquet(out).count() == 3
    run_stream(q.expect_or_drop(read(), rules), ckpt, path=out)
    assert sorted(r.Id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]


def test_newest_complete_model_is_served(spark, tmp_path):
    path = str(tmp_path / "models")
    assert serving.newest_models(spark, path) is None
    rows = spark.createDataFrame([("s", "2024-01-01 05:30:00"), ("none", "2024-01-01 05:30:00"), ("s", None)], "ts_id string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert [r.yhat for r in serving.with_prediction(rows, None, time_col="t").collect()] == [None] * 3

    def model(a):
        text = f'{{"start_us": 1704067200000000, "intercept": {a}, "slope": 2.0, "sigma": 1.0, "season": {{"5": 0.25}}}}'
        return spark.createDataFrame([("s", text)], "ts_id string, model_json string")
    serving.store_models(model(1.0), path)
    newest = serving.store_models(model(10.0), path)
    assert newest.split("/")[-1].startswith("v-00000001-")
    model(99.0).write.parquet(f"{path}/v-00000002-broken")
    (tmp_path / "models" / "v-00000002-broken" / "_SUCCESS").unlink()  # a version that was never completed
    got = serving.with_prediction(rows, serving.newest_models(spark, path), time_col="t").collect()
    assert sorted(((r.ts_id, r.t is None, r.yhat) for r in got), key=str) == [("none", False, None), ("s", False, 10.0 + 2 * 5.5 + 0.25), ("s", True, None)]


def test_daily_ids_equal_the_joined_form(spark):
    """Ids that stand once, at several times of a day, at times without a reading, on several days; null ids and times; times that
    several locations and rows share."""
    rnd = random.Random(4)
    times = [f"2024-01-0{1 + d} 0{h}:00:00" for d in range(2) for h in range(5)] + [None]
    silver = [(rnd.choice("xyz"), rnd.choice("mn"), rnd.choice(times), rnd.choice([None, 1.5, 2.0, 7.25])) for _ in range(80)]
    right = {m: [(rnd.choice(times), rnd.choice([None, *range(12)])) for _ in range(60)] for m in "mn"}
    ts = lambda df: df.withColumn("MeasurementDateTime", F.col("MeasurementDateTime").cast("timestamp_ntz"))
    s = ts(spark.createDataFrame(silver, "SensorLocation string, SensorMeasurement string, MeasurementDateTime string, SensorValue double"))
    s = s.withColumn("SensorValue", F.col("SensorValue").cast("decimal(18,2)"))
    verified = {f"ids_{m}": (m, ts(spark.createDataFrame(rows, "MeasurementDateTime string, Id int"))) for m, rows in right.items()}
    for fan in (True, False):
        got = {(r.SensorLocation, str(r.MDate)[:10], r.SensorMeasurement): r for r in gold.gold_daily(s, verified, None, keep_join_fanout=fan).collect()}
        groups = {}
        for loc, m, t, v in silver:
            groups.setdefault((loc, str(t)[:10], m), []).append((t, v))
        assert set(got) == set(groups)
        for key, rows in groups.items():
            joined = [(v, i) for t, v in rows for i in ([i for u, i in right[key[2]] if u == t and t is not None] or [None])]
            counted = joined if fan else [(v, None) for _, v in rows]
            values, r = [v for v, _ in counted if v is not None], got[key]
            assert r.RecordsInDay == len(counted) and r.Midpoint == (pytest.approx(sum(values) / len(values), abs=1e-6) if values else None)
            assert r[f"ids_{key[2]}"] == len({i for _, i in joined if i is not None}) and r[f"ids_{'n' if key[2] == 'm' else 'm'}"] == 0
