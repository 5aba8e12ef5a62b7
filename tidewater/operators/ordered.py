"""Global row positions in a sort order, computed without a single-task sort.

``with_global_positions`` range-partitions on the order (Spark samples the key range, so a
key holding a third of all rows is cut into many partitions), sorts within partitions,
tags rows with ``monotonically_increasing_id`` (partition index << 33 | row index) and
writes once to the shared checkpoint folder - fixing the tags and cutting the lineage.
The position is then the number of rows in earlier partitions plus the row index; the
offset table has one row per partition (a size bound we choose) and is broadcast.

Positions turn "previous/next row of the same key" into equi-joins on ``_pos +- 1`` (a
unique key: uniform shuffle whatever the key skew) and "the k rows before" into
fixed-size buckets with a halo (``moving_average_halo``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits
PARTITION_BYTES, LEAST_BYTES = 256 * 1024 * 1024, 4 * 1024 * 1024
MOST = 64  # times the session's partitions: estimates of joins and of unknown sources can be far too high


def range_partitions(df: DataFrame, partition_bytes: int = PARTITION_BYTES, least_bytes: int = LEAST_BYTES) -> int:
    """Partitions for a range shuffle: the session's shuffle partitions; more where Catalyst's size estimate says that a partition would
    hold over ``partition_bytes``, fewer where it would hold under ``least_bytes`` (a range shuffle isn't coalesced at run time)."""
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(min(base, -(-size // least_bytes)), min(-(-size // partition_bytes), MOST * base), 1)


def with_global_positions(df: DataFrame, order_by: Sequence[str], num_partitions: int | None = None,
                          work_dir: str | None = None, pos_col: str = "_pos") -> DataFrame:
    """``df`` plus ``pos_col``: 0-based rank of each row in ``order_by`` (which must be
    unique - end it with an id column)."""
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = range_partitions(df)
    path = work_dir or scratch_dir(spark, "positions")
    (df.repartitionByRange(num_partitions, *order_by)
       .sortWithinPartitions(*order_by)
       .withColumn("_mid", F.monotonically_increasing_id())
       .write.mode("overwrite").parquet(path))
    tagged = spark.read.parquet(path)
    pid = F.shiftright(F.col("_mid"), _ROW_BITS)
    loc = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    tagged = tagged.withColumns({"_pid": pid, "_loc": loc})
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(pos_col, F.col("_off") + F.col("_loc"))
                  .drop("_mid", "_pid", "_loc", "_off"))


def next_in_group(positioned: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  pos_col: str = "_pos", prefix: str = "_next_") -> DataFrame:
    """For each row, ``columns`` of the following row of the same key (NULL for the last
    row of a key): an equi-join on position + 1, uniform whatever the key skew."""
    nxt = positioned.select((F.col(pos_col) - 1).alias(pos_col),
                            *[F.col(k).alias(f"_nk_{k}") for k in keys],
                            *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    j = positioned.join(nxt, pos_col, "left")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_nk_{k}").eqNullSafe(F.col(k))
    return j.select(*positioned.columns,
                    *[F.when(same, F.col(f"{prefix}{c}")).alias(f"{prefix}{c}") for c in columns])
