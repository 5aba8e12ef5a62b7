"""Batch history of tables (the re-aimed ``DESCRIBE HISTORY``).

Every audited write appends one row (table, operation, batch id, rows written, time) to
an audit table.  Row counts come from ``observe`` on the written DataFrame, so the write
itself counts its rows - no second pass over the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = "table_name string, operation string, batch_id long, num_rows long, written_at timestamp, write_id string"


class AuditLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, df: DataFrame, table_name: str, operation: str, batch_id: int | None,
              do_write: Callable[[DataFrame], None]) -> int:
        obs = Observation(f"audit-{uuid.uuid4().hex[:8]}")
        do_write(df.observe(obs, F.count(F.lit(1)).alias("n")))
        n = int(obs.get.get("n", 0))
        row = [(table_name, operation, batch_id, n, None, uuid.uuid4().hex)]
        (self.spark.createDataFrame(row, AUDIT_SCHEMA).withColumn("written_at", F.current_timestamp())
             .write.mode("append").parquet(self.path))
        return n

    def history(self, table_name: str | None = None) -> DataFrame:
        h = self.spark.read.parquet(self.path)
        return h.filter(F.col("table_name") == table_name) if table_name else h

