"""day truncation and time windows, as flat columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc("day", c).cast("timestamp_ntz")


def window_columns(prefix: str = "window") -> list[Column]:
    return [F.col(f"{prefix}.start").alias(f"{prefix}_start"), F.col(f"{prefix}.end").alias(f"{prefix}_end")]
