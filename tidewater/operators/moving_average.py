"""Exact row-frame moving averages (``avg(v) OVER (ORDER BY ts ROWS BETWEEN k PRECEDING
AND CURRENT ROW)``), plainly and at scale.

The gold tables average the last 31 and the last 366 readings.  Written literally the
window has no PARTITION BY, so Spark moves every row into a single task.  ``moving_average_halo``
computes the same numbers with balanced tasks and one shuffle of the rows:

1. range-partition on (series, time, Id) - Spark samples the key range, so even a series
   holding a third of all rows is cut into many partitions - and sort within partitions;
2. in the same stage slide the frames over each sorted partition (Arrow batches, exact running
   sums, k rows of context) and write rows and averages once to the shared checkpoint folder (cuts
   lineage: a lost executor re-reads instead of re-sampling).  All rows are final but the first k of a
   partition, whose frames begin in an earlier one;
3. only those and the last k rows of every partition move again: in their common order the k rows before
   a first row are the ends of as many partitions as it takes (short ones follow one another), so buckets of
   that order with a halo of k rows give the missing averages.

What moves a second time is 2k rows a partition, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from .ordered import range_partitions

DEFAULT_FRAMES = {"ShortMovingAverage": 30, "LongMovingAverage": 365}


def _with_frame_averages(df: DataFrame, value: str, w, frames: Mapping[str, int]) -> DataFrame:
    """avg over ``ROWS BETWEEN k PRECEDING AND CURRENT ROW`` for each frame, in O(n).

    A bounded ROWS frame makes Spark re-aggregate up to k+1 rows per output row; here a
    running decimal sum S and running count C (one incremental pass) and their values
    k+1 rows back give the frame exactly: (S_i - S_{i-k-1}) / (C_i - C_{i-k-1}).  Where
    fewer than k+1 rows precede, lag is NULL and the frame is the whole prefix.  The sum
    is exact (decimal), divided as double and rounded to 6 places."""
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    v = F.col(value)
    out = df.withColumns({"_S": F.sum(F.coalesce(v, F.lit(0).cast(df.schema[value].dataType))).over(run),
                          "_C": F.count(v).over(run)})
    cols = {}
    for name, k in frames.items():
        ds = F.col("_S") - F.coalesce(F.lag("_S", k + 1).over(w), F.lit(0))
        dc = F.col("_C") - F.coalesce(F.lag("_C", k + 1).over(w), F.lit(0))
        cols[name] = F.round(F.try_divide(ds.cast("double"), dc.cast("double")), 6)
    return out.withColumns(cols).drop("_S", "_C")


def moving_average_window(df: DataFrame, value: str = "SensorValue",
                          order_by: Sequence[str] = ("MeasurementDateTime", "Id"),
                          partition_by: Sequence[str] = (),
                          frames: Mapping[str, int] = DEFAULT_FRAMES) -> DataFrame:
    """Plain window form.  ``order_by`` must end in a unique column (ties on time would
    otherwise make the frame contents depend on shuffle order)."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by) if partition_by else Window.orderBy(*order_by)
    return _with_frame_averages(df, value, w, frames)


def _changes(batch: pa.RecordBatch, keys: Sequence[str], before: pa.RecordBatch | None) -> np.ndarray:
    """Whether each row belongs to another series than the row before it (the first one: than the last row of ``before``)."""
    out = np.zeros(batch.num_rows, dtype=bool)
    for c in keys:
        col = batch.column(c)
        col = pa.concat_arrays([before.column(c) if before else col.slice(0, 1), col])
        a, b = col.slice(0, len(col) - 1), col.slice(1)
        differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(a.is_null(), b.is_null()))
        out |= differ.to_numpy(zero_copy_only=False)
    return out


class _Slider:
    """Slides the frames over the sorted rows of one partition, batch by batch. ``head`` marks rows whose longest frame may begin in an
    earlier partition."""

    def __init__(self, keys: Sequence[str], frames: Mapping[str, int], scale: float):
        self.keys, self.frames, self.scale, self.k = list(keys), dict(frames), scale, max(frames.values())
        self.before, self.first_run, self.run_rows = None, True, 0
        self.held, self.held_n = None, None  # the last k rows of the running series: values, whether there is one

    def _scaled(self, total: np.ndarray) -> np.ndarray:
        """The sums as doubles, rounded once: whole numbers beyond 53 bits are divided as Python's."""
        if total.dtype.kind == "f" or not len(total) or max(abs(int(total.max())), abs(int(total.min()))) < 2**53:
            return total.astype(np.float64) / self.scale
        return np.array([int(t) / int(self.scale) for t in total])

    def __call__(self, batch: pa.RecordBatch, v: pa.Array) -> tuple[dict[str, pa.Array], np.ndarray]:
        n = batch.num_rows
        some = v.is_valid().to_numpy(zero_copy_only=False)
        x = pc.fill_null(v, 0).to_numpy(zero_copy_only=False)
        held = np.empty(0, dtype=x.dtype) if self.held is None else self.held
        held_n = np.empty(0, dtype=bool) if self.held is None else self.held_n
        values, counted, h = np.concatenate((held, x)), np.concatenate((held_n, some)), len(held)
        if values.dtype.kind == "i" and len(values) and float(np.abs(values.astype(np.float64)).max()) * len(values) >= 2.0**62:
            values = values.astype(object)  # sums beyond 64 bits
        sums = np.concatenate((np.zeros(1, dtype=values.dtype), np.cumsum(values)))
        counts = np.concatenate(([0], np.cumsum(counted, dtype=np.int64)))
        change = _changes(batch, self.keys, self.before)
        starts = np.flatnonzero(change)
        run = np.searchsorted(starts, np.arange(n), side="right")  # 0: the series of the batch before
        at = np.arange(n) + h
        begin = np.concatenate(([0], starts + h))[run]
        out = {}
        for name, k in self.frames.items():
            low = np.maximum(at - k, begin)
            total, c = self._scaled(sums[at + 1] - sums[low]), counts[at + 1] - counts[low]
            out[name] = pa.array(np.divide(total, c, out=np.zeros(n), where=c > 0), pa.float64(), mask=c == 0)
        in_run = np.where(run == 0, self.run_rows + np.arange(n), at - begin)
        head = (run == 0) & self.first_run & (in_run < self.k)
        if len(starts):
            self.first_run = False
        self.run_rows = int(in_run[-1]) + 1
        low = max(int(begin[-1]), len(values) - self.k)
        self.held, self.held_n = values[low:].astype(x.dtype), counted[low:]
        self.before = batch.slice(n - 1, 1)
        return out, head


def _slide(df: DataFrame, value: str, keys: Sequence[str], frames: Mapping[str, int]) -> DataFrame:
    """Rows of sorted partitions with their averages as far as the partition tells, and ``_pid``, ``_at`` (place from the partition's start), ``_end``
    (from its end, only for its last k rows) and ``_head``."""
    kind = df.schema[value].dataType
    exact = isinstance(kind, T.DecimalType) and kind.precision <= 18
    v = (F.col(value) * F.lit(10**kind.scale)).cast("long") if exact else F.col(value).cast("double")
    k, scale, names = max(frames.values()), float(10**kind.scale) if exact else 1.0, df.columns
    extra = {"_pid": "int", "_at": "long", "_end": "long", "_head": "boolean"}
    schema = T.StructType([*df.schema.fields, *(T.StructField(f, T.DoubleType()) for f in frames),
                           *(T.StructField(c, T._parse_datatype_string(t)) for c, t in extra.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slide, pid, at, waiting = _Slider(keys, frames, scale), TaskContext.get().partitionId(), 0, []  # waiting: at least the last k rows

        def out(columns: list[pa.Array], end: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*columns[:-1], end, columns[-1]], schema.names)

        for b in batches:
            if not b.num_rows:
                continue
            averages, head = slide(b, b.column("_v"))
            n, head = b.num_rows, head & (pid > 0)  # nothing comes before the first partition
            waiting.append([*(b.column(c) for c in names), *averages.values(), pa.array(np.full(n, pid, dtype=np.int32)), pa.array(np.arange(at, at + n)), pa.array(head)])
            at += n
            while sum(len(w[0]) for w in waiting[1:]) >= k:
                first = waiting.pop(0)
                yield out(first, pa.nulls(len(first[0]), pa.int64()))
        for w in waiting:
            back = at - 1 - w[-2].to_numpy()
            yield out(w, pa.array(back, pa.int64(), mask=back >= k))

    return df.withColumn("_v", v).mapInArrow(run, schema)


def moving_average_halo(df: DataFrame, value: str = "SensorValue",
                        order_by: Sequence[str] = ("MeasurementDateTime", "Id"),
                        partition_by: Sequence[str] = (),
                        frames: Mapping[str, int] = DEFAULT_FRAMES,
                        bucket_rows: int = 1 << 18, num_partitions: int | None = None,
                        work_dir: str | None = None) -> DataFrame:
    """Distributed exact form; same rows and values as ``moving_average_window``.  ``bucket_rows``: size of the buckets that the
    partitions' first and last rows are dealt to."""
    k = max(frames.values())
    if bucket_rows <= k:
        raise ValueError(f"bucket_rows ({bucket_rows}) must exceed the longest frame ({k})")
    keys, cols, spark = list(partition_by) + list(order_by), df.columns, df.sparkSession
    path = work_dir or scratch_dir(spark, "averages")
    dealt = df.repartitionByRange(num_partitions or range_partitions(df), *keys).sortWithinPartitions(*keys)
    _slide(dealt, value, partition_by, frames).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    rounded = [F.round(F.col(f), 6).alias(f) for f in frames]

    # the first and last rows of all partitions, numbered in their common order: a partition's rows follow those of earlier ones (one row a
    # partition in the table of offsets)
    edges = rows.filter(F.col("_head") | F.col("_end").isNotNull()).drop(*frames)
    first = edges.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = first.select("_pid", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.when(F.col("_head"), F.col("_at")).otherwise(F.col("_n") - 1 - F.col("_end"))
    pos = edges.join(F.broadcast(offsets), "_pid").withColumn("_pos", F.col("_off") + place)

    # buckets of that order, each with a copy of the k rows before it
    in_tail = F.pmod(F.col("_pos"), F.lit(bucket_rows)) >= bucket_rows - k
    copies = F.when(in_tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = (pos.withColumn("_copy", F.explode(copies))
               .withColumns({"_b": F.floor(F.col("_pos") / F.lit(bucket_rows)) + F.col("_copy"), "_halo": F.col("_copy") == 1}))
    w = Window.partitionBy(*partition_by, "_b").orderBy("_pos")
    heads = _with_frame_averages(both, value, w, frames).filter(~F.col("_halo") & F.col("_head")).select(*cols, *frames)
    return rows.filter(~F.col("_head")).select(*cols, *rounded).unionByName(heads)


def moving_average(df: DataFrame, value: str = "SensorValue",
                   order_by: Sequence[str] = ("MeasurementDateTime", "Id"),
                   partition_by: Sequence[str] = (),
                   frames: Mapping[str, int] = DEFAULT_FRAMES, **kw) -> DataFrame:
    """Moving averages in the distributed form, at any size; ``moving_average_window`` is the plain form."""
    return moving_average_halo(df, value, order_by, partition_by, frames, **kw)


def latest_per_key(df: DataFrame, keys: Sequence[str], sequence_by: Sequence[str] | str,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the highest sequence (then highest tiebreak).

    Uses ``max_by`` over a struct, a two-phase aggregate (map-side partial), instead of
    ``row_number`` over a window, which would sort every key group in one task."""
    seq = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
    order = F.struct(*[F.col(c) for c in seq + list(tiebreak)])
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(F.max_by(packed, order).alias("_w"))
              .select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest]))
