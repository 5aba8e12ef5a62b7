"""Run a transform over a batch or a streaming source with the same code.

``run_stream`` starts a query and waits for it when the trigger is ``availableNow`` or
``once`` (the default: process what is there, then stop - the scheduled-job form).
Each query needs its own checkpoint folder; ``start_over`` switches to a fresh one
(the incremental state is then rebuilt from all input).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..session import session_conf

Transform = Callable[[DataFrame], DataFrame]


def run(transform: Transform, read_batch: Callable[[], DataFrame], read_stream: Callable[[], DataFrame],
        mode: str = "static") -> DataFrame:
    """The same transform over the static or the streaming form of a source."""
    src = read_batch() if mode.lower() in ("static", "batch") else read_stream()
    return transform(src)


def _trigger(writer, trigger: str | Mapping[str, str | bool]):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    if isinstance(trigger, Mapping):
        return writer.trigger(**trigger)
    if trigger in ("default", None):
        return writer
    return writer.trigger(processingTime=trigger)


def run_stream(df: DataFrame, checkpoint: str, path: str | None = None, table: str | None = None,
               foreach_batch: Callable[[DataFrame, int], None] | None = None, fmt: str = "parquet",
               output_mode: str = "append", trigger: str | Mapping = "availableNow",
               query_name: str | None = None, partition_by: Sequence[str] | None = None,
               options: Mapping[str, str] | None = None, wait: bool = True,
               state_partitions: int | None = None, conf: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start a streaming query into a path, a table or a foreachBatch
    function; returns the (finished, for one-shot triggers) query.  ``state_partitions``
    sets the number of shuffle/state partitions of a new query (kept by its checkpoint
    afterwards); by default the session's ``spark.sql.shuffle.partitions`` applies.
    ``conf``: session settings that hold for this query only."""
    settings = dict(conf or {})
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = state_partitions
    with session_conf(df.sparkSession, settings):
        q = _start(df, checkpoint, path, table, foreach_batch, fmt, output_mode, trigger, query_name,
                   partition_by, options)
    if wait and (trigger in ("availableNow", "once")):
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q


def _start(df, checkpoint, path, table, foreach_batch, fmt, output_mode, trigger, query_name, partition_by,
           options) -> StreamingQuery:
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = _trigger(w, trigger)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        w = w.format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if table:
            if path:
                w = w.option("path", path)
            q = w.toTable(table)
        else:
            q = w.start(path)
    return q


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped as too late (summed over the progress
    reports kept by the query; window-exploded rows count once per window)."""
    n = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            n += int(op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark)
    return n
