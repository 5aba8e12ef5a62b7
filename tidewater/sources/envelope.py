"""Message-log envelope.

Records travel as ``key`` (the record id) and ``value`` (the JSON of the payload struct). A log is written and read with
``format('kafka')`` where the connector is on the classpath; encoding and decoding work on any table or stream
with these two columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JSON timestamps keep microseconds and the zone offset.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode(df: DataFrame, key_col: str = "Id", value_cols: Sequence[str] | None = None) -> DataFrame:
    """(key string, value JSON string) from a record's columns."""
    cols = list(value_cols or df.columns)
    return df.select(F.col(key_col).cast("string").alias("key"), F.to_json(F.struct(*cols), JSON_OPTIONS).alias("value"))


def write_log(encoded: DataFrame, topic: str, options: Mapping[str, str]) -> None:
    """K8: batch write to a topic; options such as ``kafka.bootstrap.servers`` and TLS settings pass through."""
    encoded.write.format("kafka").options(**options).option("topic", topic).save()


def read_log_stream(spark: SparkSession, topics: str, options: Mapping[str, str], starting_offsets: str = "earliest",
                    min_partitions: int | None = None) -> DataFrame:
    """Streaming read of topics (``maxOffsetsPerTrigger`` among the options limits the rate)."""
    r = (spark.readStream.format("kafka").option("subscribe", topics)
         .option("startingOffsets", starting_offsets).options(**options))
    return (r.option("minPartitions", str(min_partitions)) if min_partitions else r).load()


def to_envelope(log: DataFrame) -> DataFrame:
    """Pre-bronze envelope: ``topic`` (the key as text - it holds the record id) and the
    raw ``payload``."""
    return log.select(F.col("key").cast("string").alias("topic"), F.col("value").alias("payload"))


def decode(envelope: DataFrame, schema: T.StructType, payload_col: str = "payload",
           keep: Sequence[str] = ()) -> DataFrame:
    """Parse the JSON payload with a fixed schema and expand its fields."""
    parsed = envelope.select(*keep, F.from_json(F.col(payload_col).cast("string"), schema, JSON_OPTIONS).alias("v"))
    return parsed.select(*keep, "v.*")


def demultiplex(log: DataFrame, routes: Mapping[str, str], schema: T.StructType,
                column: str = "SensorMeasurement") -> dict[str, DataFrame]:
    """X11: split one multiplexed log into one decoded stream per record type."""
    decoded = decode(to_envelope(log), schema)
    return {name: decoded.filter(F.col(column) == F.lit(lit)) for name, lit in routes.items()}
