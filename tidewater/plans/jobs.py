"""The pipeline as three jobs (raw -> bronze -> silver -> gold), each runnable as a
one-shot incremental stream or as a static batch with the same code (R2B/B2S/S2G).

    python -m tidewater.plans.jobs raw_to_bronze     # parameters from TIDEWATER_* env vars

* ``raw_to_bronze``: typed CSV files -> cleaned rows with source file and deterministic
  ids (computed once per micro-batch, so all sinks of the batch share them) -> idempotent
  fan-out into an all-sensors table and one table per route.
* ``bronze_to_silver``: the all-sensors bronze table, read incrementally, merged per
  micro-batch into a bucketed silver table (SCD 1 by Id, latest MeasurementDateTime wins).
* ``silver_to_gold``: moving-average gold tables, the hourly forecast, the overlay view
  and the daily gold aggregate, each written as a new table version.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import RunParams
from ..functions.ids import with_deterministic_id
from ..operators import clean
from ..operators import stored
from ..sources import files, sinks
from ..sources.sinks import move_aside
from ..streaming.runner import run_stream
from . import gold

ID_COLUMNS = ["InputFileName", *S.MEASURES]


def bronze_batch(batch: DataFrame) -> DataFrame:
    """Clean a batch of raw rows and give each a deterministic id (content + file)."""
    rows = clean.clean_raw(batch).drop("Id")
    return with_deterministic_id(rows.select(*ID_COLUMNS), ID_COLUMNS)


def raw_to_bronze(spark: SparkSession, params: RunParams, routes: Mapping[str, str] = S.DEFAULT_ROUTES,
                  reference_precision: bool = False) -> dict[str, str]:
    schema = S.raw_sensor_schema(reference_precision)
    base = f"{params.target_root}/bronze"
    _start_over(spark, params, "raw_to_bronze", "bronze")

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.fanout(bronze_batch(batch), base, routes, batch_id=batch_id)

    if params.mode.lower() in ("static", "batch"):
        path = f"{params.source}/{params.file_name}" if params.file_name else params.source
        raw = clean.with_lineage(files.read_csv(spark, path, schema, header=True))
        write(raw, 0)
    else:
        src = clean.with_lineage(files.stream_csv(spark, params.source, schema, header=True))
        run_stream(src, _checkpoint(params, "raw_to_bronze"), foreach_batch=write)
    return {n: f"{base}/{n}" for n in ["all_sensors", *routes]}


def _checkpoint(params: RunParams, name: str) -> str:
    return f"{params.target_root}/_checkpoints/{name}"


def _start_over(spark: SparkSession, params: RunParams, name: str, output: str) -> None:
    """Set a job's outputs and checkpoint aside, together, so that it starts from nothing (K14). The old
    folders stay under ``_replaced/<unique>`` until somebody deletes them."""
    if params.start_over:
        aside = f"{params.target_root}/_replaced/{uuid.uuid4().hex}"
        for path in (f"{params.target_root}/{output}", _checkpoint(params, name)):
            move_aside(spark, path, f"{aside}/{path.rsplit('/', 1)[1]}")


def silver_table(spark: SparkSession, params: RunParams, n_buckets: int = 4) -> stored.BucketedTable:
    """Silver, partitioned by sensor so that gold's sensor filters prune; ``n_buckets`` per sensor belongs to the table."""
    return stored.BucketedTable(spark, f"{params.target_root}/silver/all_sensors", ["Id", "SensorMeasurement"], n_buckets,
                            partition_by=["SensorMeasurement"])


def bronze_to_silver(spark: SparkSession, params: RunParams, n_buckets: int = 4) -> str:
    bronze_path = f"{params.target_root}/bronze/all_sensors"
    _start_over(spark, params, "bronze_to_silver", "silver")
    silver = silver_table(spark, params, n_buckets)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.drop(sinks.BATCH_COL, "InputFileName")
        silver.upsert(rows, sequence_by="MeasurementDateTime")

    if params.mode.lower() in ("static", "batch"):
        merge(spark.read.parquet(bronze_path), 0)
    else:
        schema = spark.read.parquet(bronze_path).schema
        src = spark.readStream.schema(schema).parquet(bronze_path)
        run_stream(src, _checkpoint(params, "bronze_to_silver"), foreach_batch=merge)
    return silver.path


def silver_to_gold(spark: SparkSession, params: RunParams) -> dict[str, str]:
    root = params.target_root
    silver = silver_table(spark, params).read()
    out = {}

    def write(df: DataFrame, name: str) -> None:
        path = f"{root}/gold/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = path

    write(gold.ma_table(silver, S.AIR_TEMP, gold.AIR_FRAMES), "airtempanalysis")
    write(gold.ma_table(silver, S.WATER_QUALITY, gold.WATER_FRAMES), "waterqualityanalysis")
    write(gold.silver_hourly_forecast(silver), "silver_hourly_forecast")
    view = gold.water_quality_forecast(spark.read.parquet(out["waterqualityanalysis"]),
                                       spark.read.parquet(out["silver_hourly_forecast"]))
    verified = {c: (lit, clean.route(silver, lit)) for c, lit in gold.VERIFIED_COLUMNS.items()}
    write(gold.gold_daily(silver, verified, view), "gold_aggregates")
    return out


JOBS = {"raw_to_bronze": raw_to_bronze, "bronze_to_silver": bronze_to_silver, "silver_to_gold": silver_to_gold}


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in JOBS:
        raise SystemExit(f"usage: python -m tidewater.plans.jobs {{{'|'.join(JOBS)}}}")
    spark = SparkSession.builder.getOrCreate()
    from ..session import ensure_session_conf
    ensure_session_conf(spark)
    print(JOBS[argv[0]](spark, RunParams.from_env()))


if __name__ == "__main__":
    main(sys.argv[1:])
