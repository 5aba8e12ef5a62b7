"""Raw -> bronze cleaning, renaming, lineage columns and routing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


def clean_raw(df: DataFrame, require=("WindowAverageStartDateTime", "SensorValue"),
              drop=tuple(S.RAW_DROP_COLUMNS)) -> DataFrame:
    """Keep rows where every ``require`` column is set, drop the export's
    bookkeeping columns.  Comment and header lines of annotated exports parse to NULL
    times, so this filter also removes them."""
    cond = None
    for c in require:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    out = df.filter(cond) if cond is not None else df
    return out.drop(*[c for c in drop if c in df.columns])


def with_lineage(df: DataFrame, file_col: str = "InputFileName", event_time: str | None = None) -> DataFrame:
    """Add the source file path (from the ``_metadata`` column of file sources)
    and optionally an ingest time."""
    out = df.withColumn(file_col, F.col("_metadata.file_path"))
    if event_time:
        out = out.withColumn(event_time, F.current_timestamp())
    return out


def bronze_rename(df: DataFrame) -> DataFrame:
    """The SQL pipeline's bronze projection: renamed window columns, values cast
    with ``try_cast`` (ANSI casts raise on header rows)."""
    return df.select(
        F.col("WindowAverageStartDateTime").alias("MeasurementWindowStartTime"),
        F.col("WindowAverageStopDateTime").alias("MeasurementWindowEndTime"),
        F.expr("try_cast(MeasurementDateTime AS TIMESTAMP)").alias("MeasurementDateTime"),
        F.col("SensorValue"),
        F.col("SensorUnitDescription"),
        F.col("SensorMeasurement"),
        F.col("SensorLocation"),
        F.col("Id"),
        *([F.col("inputFileName")] if "inputFileName" in df.columns else []),
    )


def route(df: DataFrame, measurement: str, column: str = "SensorMeasurement") -> DataFrame:
    """Equality filter on the discriminator (pushed down to Parquet scans)."""
    return df.filter(F.col(column) == F.lit(measurement))


def routes(df: DataFrame, config: Mapping[str, str] = S.DEFAULT_ROUTES,
           column: str = "SensorMeasurement") -> dict[str, DataFrame]:
    """One filtered DataFrame per configured route."""
    return {name: route(df, lit, column) for name, lit in config.items()}


def route_tagged(df: DataFrame, config: Mapping[str, str] = S.DEFAULT_ROUTES,
                 column: str = "SensorMeasurement", route_col: str = "route") -> DataFrame:
    """All routes in one DataFrame with the route name as a column (a single pass; a row
    matching several routes appears once per route, unmatched rows are dropped)."""
    pairs = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(v).alias("v")) for n, v in config.items()])
    matched = F.filter(pairs, lambda p: p["v"] == F.col(column))
    return (df.withColumn("_r", F.explode(matched))
              .withColumn(route_col, F.col("_r.n")).drop("_r"))


def unique_values(df: DataFrame, column: str = "SensorMeasurement") -> DataFrame:
    """Distinct values of a column (two-phase aggregate)."""
    return df.select(column).distinct()
