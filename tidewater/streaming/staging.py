"""Stage data as files arriving over time (for stream queries and tests).

Writes a DataFrame as consecutive chunks of a time column, one write job per chunk, so
file modification times follow event time - the order a file stream source reads them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def cut_times(df: DataFrame, time_col: str, parts: int = 3) -> list:
    """Times that cut the table's span into equal parts, in whole microseconds: one aggregate over the time column."""
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    low, high = df.agg(F.min(us), F.max(us)).first()
    if low is None:
        return []
    edges = [low + (high - low) * i // parts for i in range(1, parts)]
    times = df.sparkSession.createDataFrame([(e,) for e in edges], "us long").select(F.timestamp_micros("us").cast("timestamp_ntz"))
    return sorted(r[0] for r in times.collect())


def chunks(df: DataFrame, time_col: str, bounds: Sequence | None = None) -> list[DataFrame]:
    """The rows before, between and after the bounds (by default thirds of the table's time span)."""
    t = F.col(time_col).cast("timestamp_ntz")
    edges = [F.lit(b).cast("timestamp_ntz") for b in (cut_times(df, time_col) if bounds is None else bounds)]
    parts = []
    for i in range(len(edges) + 1):
        cond = F.lit(True)
        if i > 0:
            cond = cond & (t >= edges[i - 1])
        if i < len(edges):
            cond = cond & (t < edges[i])
        parts.append(df.filter(cond))
    return parts


def stage(df: DataFrame, path: str, time_col: str, fmt: str = "parquet",
          bounds: Sequence | None = None, options: dict | None = None) -> Iterator[int]:
    """Write chunk after chunk into ``path``; yields the chunk number after each write so
    the caller can run its incremental query in between."""
    for i, part in enumerate(chunks(df, time_col, bounds)):
        part.write.mode("append").format(fmt).options(**(options or {})).save(path)
        yield i
