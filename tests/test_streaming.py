"""Late data against a 10-minute watermark (FIXTURES.md late_data), output modes."""
import json
import os
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.streaming import operators as so
from tidewater.streaming.runner import dropped_by_watermark, run_stream

SCHEMA = T.StructType([T.StructField("Id", T.StringType()), T.StructField("MeasurementDateTime", T.TimestampType()),
                       T.StructField("SensorValue", T.DoubleType()), T.StructField("SensorLocation", T.StringType()),
                       T.StructField("SensorMeasurement", T.StringType())])


def _files(d, groups):
    os.makedirs(d, exist_ok=True)
    base = time.time() - 1000
    for i, times in enumerate(groups):
        p = os.path.join(d, f"f{i}.json")
        with open(p, "w") as fh:
            for j, t in enumerate(times):
                fh.write(json.dumps({"Id": f"{i}-{j}", "MeasurementDateTime": f"2024-01-01T{t}:00Z",
                                     "SensorValue": 1.0, "SensorLocation": "s", "SensorMeasurement": "m"}) + "\n")
        os.utime(p, (base + 10 * i, base + 10 * i))


def _run(spark, tmp_path, groups, slide):
    src_dir = str(tmp_path / "in")
    _files(src_dir, groups)
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src_dir)
    agg = so.windowed_stats(src, "10 minutes", "10 minutes", slide)
    q = run_stream(agg, str(tmp_path / "ck"), fmt="noop", output_mode="update")
    return dropped_by_watermark(q)


def test_late_row_kept_when_watermark_lags(spark, tmp_path):
    assert _run(spark, tmp_path, [["00:00", "01:00"], ["00:05", "02:00"], ["03:00"]], None) == 0


def test_late_row_dropped(spark, tmp_path):
    assert _run(spark, tmp_path / "t", [["00:00", "01:00"], ["02:00"], ["00:05", "03:00"]], None) == 1
    assert _run(spark, tmp_path / "s", [["00:00", "01:00"], ["02:00"], ["00:05", "03:00"]], "5 minutes") == 2


def test_interval_join_matches_brute_force(spark):
    import random
    rnd = random.Random(3)
    left = [(i, rnd.choice("ab"), rnd.randint(0, 3000)) for i in range(300)]
    right = [(100 + i, rnd.choice("ab"), rnd.randint(0, 3000)) for i in range(300)]
    ldf = spark.createDataFrame(left, "Id int, k string, s int").select(
        "Id", "k", F.timestamp_seconds("s").alias("t"))
    rdf = spark.createDataFrame(right, "Rid int, k string, s int").select(
        "Rid", "k", F.timestamp_seconds("s").alias("rt"))
    got = sorted((r["Id"], r["Rid"]) for r in so.interval_join(ldf, rdf, ["k"], "t", "rt", -30, 90).collect())
    want = sorted((a, b) for a, ka, sa in left for b, kb, sb in right if ka == kb and sa - 30 <= sb <= sa + 90)
    assert got == want


def _hot_sessions(spark, path, conf):
    src = spark.readStream.schema(SCHEMA).parquet(path)
    q = run_stream(so.session_stream(src, "5 minutes", "10 minutes"), f"{path}-ck-{len(conf)}", fmt="noop", conf=conf)
    return q.recentProgress[0]


def test_sessions_of_a_hot_key_are_merged_before_the_shuffle(spark, tmp_path):
    """20,000 readings of one key in two sessions: what reaches the state is sessions, not readings."""
    path = str(tmp_path / "in")
    s = F.when(F.col("id") < 10000, F.col("id") / 100).otherwise(10000 + F.col("id") / 100)
    df = spark.range(0, 20000, 1, 8).select(F.col("id").cast("string").alias("Id"), F.timestamp_seconds(1704067200 + s).alias("MeasurementDateTime"),
                                            F.lit(1.0).alias("SensorValue"), F.lit("s").alias("SensorLocation"), F.lit("m").alias("SensorMeasurement"))
    df.write.parquet(path)
    state = _hot_sessions(spark, path, so.SESSION_CONF)["stateOperators"][0]
    assert state["numRowsUpdated"] == 2 and state["numRowsTotal"] <= 2
    q = spark.readStream.schema(SCHEMA).parquet(path)
    out = run_stream(so.session_stream(q, "5 minutes", "10 minutes"), f"{path}-ck-memory", fmt="memory", query_name="hot_sessions", output_mode="append", conf=so.SESSION_CONF)
    plan = out._jsq.explainInternal(False)
    exchange = plan.index("Exchange hashpartitioning")
    assert "MergingSessions" in plan[exchange:]  # below the shuffle too, not only above it
    rows = spark.table("hot_sessions").collect()
    assert [(r.NumMeasurements, r.AvgSensorValue) for r in rows] == [(10000, 1.0)]  # the second is still open
