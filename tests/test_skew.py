"""A series holding most rows is still spread evenly over tasks."""
from pyspark.sql import functions as F

from tidewater.operators.moving_average import moving_average_halo, moving_average_window
from tidewater.operators.ordered import with_global_positions


def _hot(spark, n=40_000):
    return (spark.range(n)
            .withColumn("s", F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")))
            .withColumn("MeasurementDateTime", F.timestamp_seconds((F.col("id") / 7).cast("long")).cast("timestamp_ntz"))
            .withColumn("SensorValue", (F.col("id") % 97).cast("decimal(18,2)"))
            .withColumnRenamed("id", "Id"))


def test_hot_series_positions_are_balanced(spark, tmp_path):
    df = _hot(spark)
    pos = with_global_positions(df, ["s", "MeasurementDateTime", "Id"], num_partitions=8,
                                work_dir=str(tmp_path / "pos"))
    written = spark.read.parquet(str(tmp_path / "pos"))      # one file per range partition
    per_file = [r["count"] for r in written.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(per_file) == 40_000 and len(per_file) >= 8
    assert max(per_file) <= 2 * 40_000 / 8          # the 90 % series is cut into many ranges
    assert pos.agg(F.countDistinct("_pos"), F.min("_pos"), F.max("_pos")).first() == (40_000, 0, 39_999)


def test_hot_series_halo_equals_window(spark, tmp_path):
    df = _hot(spark, 12_000)
    frames = {"short": 30, "long": 365}
    a = moving_average_window(df, frames=frames, partition_by=("s",))
    b = moving_average_halo(df, frames=frames, partition_by=("s",), bucket_rows=1024, num_partitions=6,
                            work_dir=str(tmp_path / "halo"))
    cols = ["Id", "short", "long"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_range_partitions_follow_the_size_estimate(spark, tmp_path):
    from tidewater.operators.ordered import range_partitions
    _hot(spark).write.parquet(str(tmp_path / "t"))
    df, base = spark.read.parquet(str(tmp_path / "t")), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_partitions(df) == 1  # far below one partition's size
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert range_partitions(df, least_bytes=size // 3 + 1) == 3 and range_partitions(df, least_bytes=1) == base
    assert range_partitions(df, partition_bytes=size // (3 * base) + 1) == 3 * base
    assert range_partitions(df, partition_bytes=1) == 64 * base
