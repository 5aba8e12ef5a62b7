"""Sinks and write modes (K1-K14): table writes, fan-out of one batch to many tables,
idempotent per-batch appends, schema evolution, table copy and replace."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import clean

BATCH_COL = "_batch_id"


def write_table(df: DataFrame, path: str | None = None, name: str | None = None, mode: str = "append",
                partition_by: Sequence[str] | None = None, fmt: str = "parquet",
                max_records_per_file: int | None = None, options: Mapping[str, str] | None = None) -> None:
    """K1/K7: batch write by path and/or catalog name; ``mode`` append / overwrite /
    error / ignore."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if name:
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
    else:
        w.save(path)


def append_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """K9: idempotent append of a micro-batch: rows land in partition ``_batch_id`` and
    the write replaces that partition only, so a replayed batch overwrites itself instead
    of adding its rows twice."""
    (df.withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(BATCH_COL, *partition_by).parquet(path))


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The rows ``append_batch`` wrote for one batch: its own folder, without listing the table."""
    return spark.read.parquet(f"{path}/{BATCH_COL}={int(batch_id)}")


def fanout(batch: DataFrame, base_path: str, routes: Mapping[str, str] = S.DEFAULT_ROUTES,
           all_name: str = "all_sensors", batch_id: int | None = None, mode: str = "append",
           column: str = "SensorMeasurement") -> dict[str, str]:
    """Write one batch to an all-rows table and one table per route.

    With ``batch_id`` (the streaming case) the batch is computed once and written to the
    all-rows table (``append_batch``: idempotent per batch id); every route is then cut
    from those freshly written files (partition pruning on the batch id, the route filter
    pushed to the scan) - no cached copy that a lost executor would take with it, and read
    partitions sized by the files.  Without ``batch_id`` the batch is persisted for the
    route writes and ``mode`` applies (``overwrite`` keeps only the last batch)."""
    paths = {all_name: f"{base_path}/{all_name}", **{n: f"{base_path}/{n}" for n in routes}}
    if batch_id is not None:
        append_batch(batch, paths[all_name], batch_id)
        written = read_batch(batch.sparkSession, paths[all_name], batch_id)
        for name, part in clean.routes(written, routes, column).items():
            append_batch(part, paths[name], batch_id)
        return paths
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, part in {all_name: batch, **clean.routes(batch, routes, column)}.items():
            part.write.mode(mode).parquet(paths[name])
    finally:
        batch.unpersist()
    return paths


def fanout_writer(base_path: str, routes: Mapping[str, str] = S.DEFAULT_ROUTES,
                  prepare: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """K3: a ``foreachBatch`` function doing an idempotent fan-out of each micro-batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        fanout(prepare(batch) if prepare else batch, base_path, routes, batch_id=batch_id)
    return run


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """K6: Parquet folder written with several schema versions, read with merged schema."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def copy_tables(spark: SparkSession, source_db: str, target_db: str, location_root: str | None = None) -> list[str]:
    """Copy every table (not views) of a database into another database, with its partitioning."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target_db}")
    copied = []
    for t in spark.catalog.listTables(source_db):
        if t.tableType == "VIEW" or t.isTemporary:
            continue
        w = spark.table(f"{source_db}.{t.name}").write.mode("overwrite").format("parquet")
        parts = [c.name for c in spark.catalog.listColumns(f"{source_db}.{t.name}") if c.isPartition]
        if parts:
            w = w.partitionBy(*parts)
        if location_root:
            w = w.option("path", f"{location_root}/{target_db}/{t.name}")
        w.saveAsTable(f"{target_db}.{t.name}")
        copied.append(t.name)
    return copied


def drop_tables_like(spark: SparkSession, db: str, pattern: str) -> list[str]:
    """Drop the tables of a database whose names match a LIKE pattern."""
    names = [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").filter(F.col("tableName").like(pattern)).collect()]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{n}")
    return names


def move_aside(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder within its file system, if it is there (start over keeps what it replaces)."""
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(source):
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"could not move {path} to {to}")


def replace_table(spark: SparkSession, df: DataFrame, name: str, location_root: str,
                  partition_by: Sequence[str] | None = None) -> str:
    """L2: ``CREATE OR REPLACE TABLE ... AS SELECT`` for Parquet: write the result to a
    new location, then create the catalog entry anew for it, with the new columns and partitions
    (files are never half-written, and the query may read the table it replaces; the
    old version's files stay)."""
    location = f"{location_root.rstrip('/')}/{name.replace('.', '/')}/v-{uuid.uuid4().hex[:12]}"
    w = df.write.format("parquet").mode("error")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(location)
    spark.sql(f"DROP TABLE IF EXISTS {name}")   # external: only the entry goes
    spark.catalog.createTable(name, path=location, source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return location
