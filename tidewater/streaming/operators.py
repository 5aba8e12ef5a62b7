"""Streaming-capable stateful operators.

Each works unchanged on a batch DataFrame (watermarks are ignored there), so the batch
SQL is the oracle of the streaming result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import stored


def as_event_time(df: DataFrame, col: str = "MeasurementDateTime") -> DataFrame:
    """Watermarks need TIMESTAMP (with zone); NTZ columns are cast (session zone UTC)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def windowed_stats(df: DataFrame, watermark: str | None = "10 minutes", size: str = "10 minutes",
                   slide: str | None = "5 minutes", time_col: str = "MeasurementDateTime",
                   keys: Sequence[str] = agg.SENSOR_KEYS) -> DataFrame:
    """Statistics per (keys, window) with a watermark for late data; in append
    mode a window is emitted once the watermark passes its end."""
    src = df.withWatermark(time_col, watermark) if watermark else df
    return agg.window_stats(src, size, slide, time_col, keys)


# Sessions of one input partition are merged before the shuffle (off by default): a task sends one row per
# (key, session it has seen) instead of every reading, and a key's state holds its open sessions only.
SESSION_CONF = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def session_stream(df: DataFrame, gap: str = "30 minutes", watermark: str = "10 minutes", time_col: str = "MeasurementDateTime",
                   keys: Sequence[str] = agg.SENSOR_KEYS) -> DataFrame:
    """Session statistics of a stream in two stages; start it with ``conf=SESSION_CONF``.

    Each task first merges the readings of its own partition into sessions (its sort spills), and only
    those partial sessions - keys, interval, running sums - are shuffled, merged with each other and with the
    key's open sessions, and kept as state until the watermark passes their end. So a key that holds most of the readings
    costs the state store one row per open session, whatever the number of readings."""
    return agg.session_stats_builtin(df.withWatermark(time_col, watermark), gap, time_col, keys)


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], time_col: str = "MeasurementDateTime",
                           watermark: str = "1 hour") -> DataFrame:
    """Drop repeated keys; state is kept only while the watermark allows repeats."""
    return df.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(list(keys))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
                  lower_seconds: int, upper_seconds: int, bucket_seconds: int | None = None,
                  how: str = "inner") -> DataFrame:
    """``r.t BETWEEN l.t + lower AND l.t + upper`` on equal keys.

    The time range becomes an extra equi-key: right rows get bucket floor(t / w); each
    left row is copied to the (at most two, as w >= upper - lower) buckets its range
    touches.  So the join is a hash join on (keys, bucket) followed by the exact range
    filter - no nested loop over all rows of a key - in batch and in streaming (where the
    range condition also bounds the join state together with both watermarks).
    ``right`` columns must not clash with ``left`` ones except for ``keys``."""
    if how != "inner":
        raise ValueError("interval_join is an inner join: a left row stands in several buckets, so an outer form would add null rows")
    w = bucket_seconds or max(1, upper_seconds - lower_seconds)
    if w < upper_seconds - lower_seconds:
        raise ValueError("bucket must be at least as wide as the time range")
    lt = F.unix_seconds(F.col(left_time).cast("timestamp"))
    lo = F.floor((lt + F.lit(lower_seconds)) / F.lit(w))
    hi = F.floor((lt + F.lit(upper_seconds)) / F.lit(w))
    l2 = left.withColumn("_jb", F.explode(F.sequence(lo, hi)))
    r2 = right.withColumn("_jb", F.floor(F.unix_seconds(F.col(right_time).cast("timestamp")) / F.lit(w)))
    cond = [l2[k] == r2[k] for k in keys] + [l2["_jb"] == r2["_jb"]]
    cond.append(r2[right_time] >= l2[left_time] + F.make_dt_interval(secs=F.lit(lower_seconds)))
    cond.append(r2[right_time] <= l2[left_time] + F.make_dt_interval(secs=F.lit(upper_seconds)))
    j = l2.join(r2, cond)
    return j.select(*[l2[c] for c in left.columns], *[r2[c] for c in right.columns if c not in keys])


def window_counts(df: DataFrame, size: str, keys: Sequence[str], time_col: str, name: str,
                  watermark: str | None = None) -> DataFrame:
    src = df.withWatermark(time_col, watermark) if watermark else df
    out = src.groupBy(*keys, F.window(F.col(time_col), size).alias("window")).agg(F.count(F.lit(1)).alias(name))
    return out


def window_join(left: DataFrame, right: DataFrame, size: str, keys: Sequence[str], time_col: str,
                watermark: str | None = "10 minutes") -> DataFrame:
    """Per-window counts of two streams joined on (keys, window)."""
    lc = window_counts(left, size, keys, time_col, "left_count", watermark)
    rc = window_counts(right, size, keys, time_col, "right_count", watermark)
    j = lc.join(rc, [*keys, "window"])
    return j.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "left_count", "right_count")


def upsert_batches(table: stored.BucketedTable, sequence_by: str | None = None, tiebreak: Sequence[str] = ()):
    """``foreachBatch`` function merging each micro-batch into a bucketed table
    (with ``sequence_by`` the latest row of a key wins, in the batch and against the table; without
    it a batch with two rows for a key is refused)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, sequence_by=sequence_by, tiebreak=tiebreak)
    return run
