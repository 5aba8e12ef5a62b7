"""JSON quarantine verdicts, deterministic ids."""
from pyspark.sql import functions as F

from tidewater.functions import ids, json_check


def test_json_quarantine(spark):
    texts = ['{"a":1}', '{a:1}', 'NaN', '', '{"a":1} x', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    lenient = [r[0] for r in df.select(json_check.malformed_json("t")).collect()]
    strict = [r[0] for r in df.select(json_check.malformed_json("t", strict=True)).collect()]
    assert lenient == ['', '{a:1}', 'NaN', '', '', None]          # Spark accepts the trailing text
    assert strict == ['', '{a:1}', 'NaN', '', '{"a":1} x', None]


def test_deterministic_ids_distinct_and_stable(spark):
    rows = [("a", 1)] * 5 + [("b", 2)] * 2 + [("c", 3)]
    df = spark.createDataFrame(rows, "m string, v int")
    a = ids.with_deterministic_id(df, ["m", "v"], chunk=2)
    b = ids.with_deterministic_id(df.repartition(3), ["m", "v"], chunk=3)
    ia = sorted(r["Id"] for r in a.collect())
    assert len(ia) == 8 and len(set(ia)) == 8
    assert ia == sorted(r["Id"] for r in b.collect())
    assert a.groupBy("m").count().orderBy("m").collect()[0]["count"] == 5


def test_ids_of_shifted_separators_differ(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("1:a", None), ("1:a", "-"), (None, "1:a")], "m string, v string")
    assert ids.with_deterministic_id(df, ["m", "v"]).select("Id").distinct().count() == 5


def test_window_and_session(spark):
    from tidewater.operators import aggregates as agg
    df = spark.createDataFrame([
        (1, "2024-01-01 00:00:00", 1.0), (2, "2024-01-01 00:20:00", 2.0), (3, "2024-01-01 01:00:00", 3.0)],
        "Id int, t string, SensorValue double").select(
        "Id", F.col("t").cast("timestamp_ntz").alias("MeasurementDateTime"), F.col("SensorValue").cast("decimal(18,2)"),
        F.lit("s").alias("SensorLocation"), F.lit("m").alias("SensorMeasurement"))
    s = agg.session_stats(df, "30 minutes").orderBy("session_start").collect()
    assert [r["NumMeasurements"] for r in s] == [2, 1]
    w = agg.window_stats(df, "10 minutes", "5 minutes")
    assert w.count() == 6   # each reading in two sliding windows
