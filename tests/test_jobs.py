"""The three jobs end to end, stream mode, two file drops; ids shared by all sinks."""
from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import schemas as S
from tidewater.config import RunParams
from tidewater.plans import jobs
from tidewater.sources.files import TS_FORMAT

SF = "/root/testdata/sf0.001"


def _raw(spark):
    s = fx.sensors(spark, SF)
    return s.select(F.lit(None).cast("string").alias("Skip"), F.lit("_result").alias("SkipResult"),
                    F.lit("0").alias("SkipTable"), F.date_trunc("day", "MeasurementDateTime").alias("a"),
                    F.date_trunc("day", "MeasurementDateTime").alias("b"), "MeasurementDateTime", "SensorValue",
                    "SensorUnitDescription", "SensorMeasurement", "SensorLocation", F.lit("x").alias("Id"))


def test_jobs_end_to_end(spark, tmp_path):
    landing = str(tmp_path / "landing")
    raw = _raw(spark)
    p = RunParams(mode="stream", source=landing, target_root=str(tmp_path / "lake"))
    opts = {"header": "true", "timestampFormat": TS_FORMAT}
    raw.filter(F.col("MeasurementDateTime") < "2024-01-15").write.options(**opts).csv(landing)
    jobs.raw_to_bronze(spark, p)
    raw.filter(F.col("MeasurementDateTime") >= "2024-01-15").write.mode("append").options(**opts).csv(landing)
    paths = jobs.raw_to_bronze(spark, p)
    jobs.raw_to_bronze(spark, p)                                   # nothing new: no change
    bronze = spark.read.parquet(paths["all_sensors"])
    assert bronze.count() == raw.count() and bronze.select("Id").distinct().count() == raw.count()
    route_ids = spark.read.parquet(paths["water_quality"]).select("Id")
    assert route_ids.join(bronze.select("Id"), "Id", "left_anti").count() == 0     # same ids in every sink

    jobs.bronze_to_silver(spark, p)
    jobs.bronze_to_silver(spark, p)                                # idempotent
    out = jobs.silver_to_gold(spark, p)
    g = spark.read.parquet(out["gold_aggregates"])
    assert g.agg(F.sum("RecordsInDay")).first()[0] == raw.count()   # unique times: no fan-out
    ma = spark.read.parquet(out["airtempanalysis"])
    assert ma.count() == raw.filter(F.col("SensorMeasurement") == S.AIR_TEMP).count()


def test_static_mode_same_bronze(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _raw(spark).write.options(header="true", timestampFormat=TS_FORMAT).csv(landing)
    a = jobs.raw_to_bronze(spark, RunParams(mode="static", source=landing, target_root=str(tmp_path / "a")))
    b = jobs.raw_to_bronze(spark, RunParams(mode="stream", source=landing, target_root=str(tmp_path / "b")))
    cols = ["Id", "MeasurementDateTime", "SensorValue", "SensorLocation"]
    ra = sorted(map(tuple, spark.read.parquet(a["all_sensors"]).select(cols).collect()))
    rb = sorted(map(tuple, spark.read.parquet(b["all_sensors"]).select(cols).collect()))
    assert ra == rb


def test_start_over_rebuilds(spark, tmp_path):
    import dataclasses
    landing = str(tmp_path / "landing")
    raw = _raw(spark)
    raw.write.options(header="true", timestampFormat=TS_FORMAT).csv(landing)
    p = RunParams(mode="stream", source=landing, target_root=str(tmp_path / "lake"))
    jobs.raw_to_bronze(spark, p)
    for _ in range(2):
        out = jobs.raw_to_bronze(spark, dataclasses.replace(p, start_over=True))
    assert spark.read.parquet(out["all_sensors"]).count() == raw.count()
    jobs.bronze_to_silver(spark, p)
    silver = jobs.silver_table(spark, p).read().filter(F.col("SensorMeasurement") == S.AIR_TEMP)
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SensorMeasurement" in plan


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    import pytest

    from tidewater import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(Session())
    assert session.ensure_checkpoint_dir(spark)
