"""File and table sources.

All readers take a fixed schema (no inference at scale; S2 exists for exploration) and
return the same columns in batch and streaming form, so one transform serves both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Timestamps keep microseconds through CSV round trips; reading also accepts shorter
# fractions and a zone suffix (ISO exports such as 2019-08-17T00:00:00Z).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_READ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"


def _csv_options(header: bool, extra: dict | None) -> dict:
    opts = {"header": str(header).lower(), "timestampFormat": TS_READ_FORMAT,
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "mode": "PERMISSIVE"}
    opts.update(extra or {})
    return opts


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False, **options) -> DataFrame:
    """Batch CSV scan with a fixed schema (a file or a folder)."""
    return spark.read.options(**_csv_options(header, options)).schema(schema).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, header: bool = True, **options) -> DataFrame:
    """Schema inferred from the data (an extra pass over the files; for exploration)."""
    return spark.read.options(**_csv_options(header, options)).option("inferSchema", "true").csv(path)


def stream_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False,
               max_files_per_trigger: int | None = None, path_glob: str | None = None,
               recursive: bool = False, clean_source: str | None = None, archive_dir: str | None = None,
               **options) -> DataFrame:
    """Incremental discovery of new CSV files in a folder.  The checkpoint of
    the query remembers which files were read, so a restart reads only new files."""
    r = spark.readStream.options(**_csv_options(header, options)).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    return r.csv(path)


def with_file_metadata(df: DataFrame, prefix: str = "") -> DataFrame:
    """File path, name, size and modification time of each row's source file."""
    return df.withColumns({
        f"{prefix}InputFileName": F.col("_metadata.file_path"),
        f"{prefix}file_name": F.col("_metadata.file_name"),
        f"{prefix}file_size": F.col("_metadata.file_size"),
        f"{prefix}file_modification_time": F.col("_metadata.file_modification_time"),
    })


def query_files(spark: SparkSession, fmt: str, path: str, columns: str = "*") -> DataFrame:
    """``SELECT ... FROM csv.`path``` (files queried directly by SQL)."""
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{path}`")


def read_table(spark: SparkSession, name: str | None = None, path: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Batch table scan by catalog name or by path."""
    return spark.table(name) if name else spark.read.format(fmt).load(path)


def stream_table(spark: SparkSession, name: str | None = None, path: str | None = None,
                 fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A table (by name) or folder (by path) read as a stream of appended files."""
    if name:
        return spark.readStream.table(name)
    r = spark.readStream.format(fmt)
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    return r.schema(schema).load(path)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame of a schema (to create a target before the first merge)."""
    return spark.createDataFrame([], schema)


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None,
                           partition_by: list[str] | None = None) -> bool:
    """Create an empty Parquet table (optionally partitioned, at a location)."""
    if spark.catalog.tableExists(name):
        return False
    w = empty_table(spark, schema).write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return True
