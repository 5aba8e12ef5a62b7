"""Halo form equals the plain window (random n, k, B, uneven days) and brute force."""
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators.moving_average import moving_average_halo, moving_average_window


def _frame(spark, n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        day = rnd.choice([0, 0, 0, 0, 1, 5, 6, 20])       # very uneven days, many ties
        rows.append((i, f"2024-01-{1 + day:02d} {rnd.randint(0, 3):02d}:00:00", Decimal(rnd.randint(-500, 5000)) / 100,
                     rnd.choice(["a", "b", "b", "b"])))
    return spark.createDataFrame(rows, "Id int, t string, SensorValue decimal(18,2), s string").withColumn(
        "MeasurementDateTime", F.col("t").cast("timestamp_ntz")).drop("t")


@pytest.mark.parametrize("n,k,B,seed", [(1, 1, 366, 0), (700, 30, 366, 1), (2500, 365, 512, 2), (4000, 365, 4096, 3)])
def test_halo_equals_window(spark, tmp_path, n, k, B, seed):
    df = _frame(spark, n, seed)
    frames = {"ma": k, "ma0": 0}
    a = moving_average_window(df, frames=frames, partition_by=("s",))
    b = moving_average_halo(df, frames=frames, partition_by=("s",), bucket_rows=B, num_partitions=5,
                            work_dir=str(tmp_path / f"w{seed}"))
    ka = sorted(map(tuple, a.select("Id", "ma", "ma0").collect()))
    kb = sorted(map(tuple, b.select("Id", "ma", "ma0").collect()))
    assert ka == kb and len(ka) == n


def test_window_equals_brute_force(spark):
    df = _frame(spark, 900, 7)
    got = {r["Id"]: r["ma"] for r in moving_average_window(df, frames={"ma": 30}, partition_by=("s",)).collect()}
    pdf = df.toPandas().sort_values(["s", "MeasurementDateTime", "Id"])
    for _, g in pdf.groupby("s"):
        v = g["SensorValue"].astype(float).to_numpy()
        for i, idx in enumerate(g["Id"]):
            assert got[idx] == pytest.approx(np.mean(v[max(0, i - 30): i + 1]), abs=1e-6)


def test_bucket_must_exceed_frame(spark):
    with pytest.raises(ValueError):
        moving_average_halo(_frame(spark, 10, 1), frames={"m": 365}, bucket_rows=300)


@pytest.mark.parametrize("partitions,k", [(40, 30), (7, 100), (3, 3)])
def test_partitions_shorter_than_a_frame_chain(spark, tmp_path, partitions, k):
    """Frames that reach over several range partitions; nulls, single-row series, values whose sums pass 64 bits."""
    big = Decimal(9 * 10**15)
    rows = [(i, i // 2, None if i % 7 == 0 else big - i if i % 3 else -big, None if i < 40 else f"s{i % 50 if i > 290 else 0}") for i in range(300)]
    df = spark.createDataFrame(rows, "Id int, MeasurementDateTime int, SensorValue decimal(18,2), s string")
    frames = {"ma": k, "ma1": 1}
    a = moving_average_window(df, frames=frames, partition_by=("s",))
    b = moving_average_halo(df, frames=frames, partition_by=("s",), bucket_rows=k + 1, num_partitions=partitions, work_dir=str(tmp_path / "w"))
    assert sorted(map(tuple, a.select("Id", "ma", "ma1").collect())) == sorted(map(tuple, b.select("Id", "ma", "ma1").collect()))


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "Id int, MeasurementDateTime timestamp_ntz, SensorValue decimal(18,2)")
    assert moving_average_halo(df, work_dir=str(tmp_path / "w")).count() == 0
