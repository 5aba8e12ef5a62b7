"""Bucketed session windows against brute force and Spark's session_window; COPY INTO
style loading (incremental, force)."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg


def _brute(rows, gap_min):
    out = []
    for key in sorted({(r[1], r[2]) for r in rows}):
        ts = sorted(r[3] for r in rows if (r[1], r[2]) == key)
        start = prev = ts[0]
        n = 1
        for t in ts[1:]:
            if t - prev > timedelta(minutes=gap_min):
                out.append((key, start, prev + timedelta(minutes=gap_min), n))
                start, n = t, 0
            prev = t
            n += 1
        out.append((key, start, prev + timedelta(minutes=gap_min), n))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_sessions_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)
    rows, t = [], base
    for i in range(800):
        t += timedelta(minutes=rnd.choice([0, 1, 5, 29, 30, 31, 45, 120]))   # ties and exact-gap edges
        rows.append((i, rnd.choice(["a", "b"]), rnd.choice(["x", "x", "x", "y"]), t, float(rnd.randint(0, 9))))
    df = spark.createDataFrame(rows, "Id int, SensorLocation string, SensorMeasurement string, "
                                     "MeasurementDateTime timestamp_ntz, v double").withColumn(
        "SensorValue", F.col("v").cast("decimal(18,2)"))
    got = sorted(((r.SensorLocation, r.SensorMeasurement), r.session_start, r.session_end, r.NumMeasurements)
                 for r in agg.session_stats(df, "30 minutes").collect())
    assert got == _brute(rows, 30)
    builtin = sorted(((r.SensorLocation, r.SensorMeasurement), r.session_start, r.session_end, r.NumMeasurements)
                     for r in agg.session_stats_builtin(df, "30 minutes").collect())
    assert got == builtin


def test_copy_into_incremental_and_force(spark, tmp_path):
    from tidewater.sources.copy_into import copy_into, read_loaded
    src = tmp_path / "landing"
    src.mkdir()
    (src / "a.csv").write_text("1,x\n2,y\n")
    (src / "skip.txt").write_text("3,z\n")

    def select(df):
        return df.select(F.expr("try_cast(_c0 AS INT)").alias("k"), F.col("_c1").alias("v"))
    tgt, state = str(tmp_path / "t"), str(tmp_path / "state")
    copy_into(spark, str(src), tgt, state, select, n_columns=2)
    copy_into(spark, str(src), tgt, state, select, n_columns=2)          # nothing new
    assert read_loaded(spark, tgt).count() == 2
    (src / "b.csv").write_text("4,w\n")
    copy_into(spark, str(src), tgt, state, select, n_columns=2)
    assert sorted(r.k for r in read_loaded(spark, tgt).collect()) == [1, 2, 4]
    copy_into(spark, str(src), tgt, state, select, n_columns=2, force=True)   # reload everything
    assert read_loaded(spark, tgt).count() == 6
