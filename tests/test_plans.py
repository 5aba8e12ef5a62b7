"""Physical plans: pruning reaches the scan, the distributed window has no data-sized
single-partition step, no query uses a Cartesian product or nested-loop join."""
import contextlib
import io

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import schemas as S
from tidewater.operators.moving_average import moving_average_window
from tidewater.plans import gold

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _partitioned_silver(spark, tmp_path):
    s = fx.sensors(spark, SF).select("Id", "MeasurementDateTime", "SensorValue", "SensorUnitDescription",
                                     "SensorMeasurement", "SensorLocation")
    s.write.partitionBy("SensorMeasurement").parquet(str(tmp_path / "silver"))
    return spark.read.parquet(str(tmp_path / "silver"))


def test_sensor_filter_prunes_partitions_and_columns(spark, tmp_path):
    silver = _partitioned_silver(spark, tmp_path)
    df = moving_average_window(silver.filter(F.col("SensorMeasurement") == S.WATER_QUALITY), frames=gold.WATER_FRAMES).select(
        "MeasurementDateTime", "WaterTempShortMovingAverage")
    p = plan_of(df)
    assert "PartitionFilters: [isnotnull(SensorMeasurement" in p and "h2o_quality" in p
    assert "SensorUnitDescription" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_halo_shuffles_all_rows_once(spark, tmp_path):
    """The written rows are read without an exchange; only first and last rows of partitions move again, to buckets."""
    silver = _partitioned_silver(spark, tmp_path)
    df = gold.ma_table(silver, None, gold.AIR_FRAMES, partition_by=("SensorMeasurement",),
                       bucket_rows=512, num_partitions=4, work_dir=str(tmp_path / "w"))
    p = plan_of(df)
    assert "hashpartitioning(SensorMeasurement" in p and "_b#" in p
    # the only single-partition step is the table of offsets (one row per partition)
    assert p.count("Arguments: SinglePartition") <= 1
    tree = p.split("\n\n")[0]
    assert tree.count("Scan parquet") == 3 and "Window" not in tree.split("Scan parquet")[0]  # union: the first child is a plain scan
    edges = spark.read.parquet(str(tmp_path / "w")).filter("_head OR _end IS NOT NULL").count()
    assert edges <= 2 * 365 * 4


def test_gold_daily_has_no_pairwise_join(spark):
    import __spark_entry__ as E
    for name in ("gold_daily", "gold_daily_hourly", "interval_join", "verify_join"):
        p = plan_of(E.queries()[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_entry_schema_is_stable(spark):
    import __spark_entry__ as E
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert [f.dataType.simpleString() for f in a.schema.fields] == [
        "string", "timestamp_ntz", "string", "bigint", "bigint", "bigint", "bigint", "bigint",
        "double", "double", "double", "int", "double"]
