"""Idempotent incremental load of files into a table (``COPY INTO`` semantics).

Files already loaded are skipped (the file-stream checkpoint records them), so running
the load again after new files arrive appends only those; ``force=True`` starts a fresh
checkpoint and loads everything again.  Each run is a one-shot ``availableNow`` query.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..streaming.runner import run_stream
from .files import _csv_options


def positional_schema(n: int) -> T.StructType:
    """``_c0 .. _c{n-1}`` strings, as a header-less CSV is read without a schema."""
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n)])


LOAD_COL = "load_id"


def copy_into(spark: SparkSession, source_dir: str, target_path: str, state_dir: str,
              select: Callable[[DataFrame], DataFrame], n_columns: int, pattern: str = "*.csv",
              header: bool = False, force: bool = False, fmt: str = "csv") -> str:
    """Load files of ``source_dir`` matching ``pattern`` that were not loaded before;
    ``select`` projects/casts the positional columns (use ``try_cast``: a header or
    comment line must not fail the load).  Returns the checkpoint used.

    Each micro-batch overwrites its own partition ``load_id=<run>-<batch>`` of the target,
    so a replayed batch replaces itself, and a forced reload (new checkpoint, new run id)
    adds its rows beside the earlier loads - like COPY INTO with ``force``."""
    checkpoint = f"{state_dir}/copy-{uuid.uuid4().hex[:8]}" if force else f"{state_dir}/copy"
    run_id = checkpoint.rstrip("/").rsplit("/", 1)[-1]
    src = (spark.readStream.format(fmt).options(**_csv_options(header, {}))
           .option("pathGlobFilter", pattern).schema(positional_schema(n_columns)).load(source_dir))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target_path}/{LOAD_COL}={run_id}-{batch_id:08d}")
    run_stream(select(src), checkpoint, foreach_batch=write)
    return checkpoint


def read_loaded(spark: SparkSession, target_path: str) -> DataFrame:
    """The loaded rows without the load bookkeeping column."""
    return spark.read.parquet(target_path).drop(LOAD_COL)
