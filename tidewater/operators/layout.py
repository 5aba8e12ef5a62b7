"""Table layout jobs (L6-L8): compaction to a target file size, clustering by a Z-order
(Morton) key, Parquet bloom filters.

``zorder_compact`` reads a table folder, computes per column a rank bucket from
approximate quantiles (distributed sketch; only the boundaries reach the driver),
interleaves the bucket bits into one key, range-partitions by it into
``ceil(bytes / target)`` files, sorts within files and writes a new folder.  The caller
switches readers to the new folder (``replace_table``) - the old files stay intact until
then, so a failed job leaves the table as it was.
"""

from __future__ import annotations

import bisect
import math
import uuid
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stored import Folder

TARGET_FILE_BYTES = 64 * 1024 * 1024
ZORDER_BITS = 10


def bloom_filter_options(columns: Mapping[str, int], fpp: float = 0.1) -> dict[str, str]:
    """Parquet writer options for a bloom filter per column (expected distinct values)."""
    opts = {}
    for c, ndv in columns.items():
        opts[f"parquet.bloom.filter.enabled#{c}"] = "true"
        opts[f"parquet.bloom.filter.expected.ndv#{c}"] = str(ndv)
        opts[f"parquet.bloom.filter.fpp#{c}"] = str(fpp)
    return opts


RANK_SAMPLE = 20_000  # rows (drawn evenly, so a value counts as often as it occurs) whose quantiles cut a string column


def _as_number(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("double")
    return F.col(c).cast("double")


def _string_rank(df: DataFrame, c: str, n: int) -> Column:
    """Bucket of a string among the quantiles of a bounded sample of rows, compared as whole strings (code-point order)."""
    some = df.select(c).where(F.col(c).isNotNull())
    share = min(1.0, RANK_SAMPLE / max(1, some.count()))
    values = sorted(r[0] for r in (some if share == 1.0 else some.sample(share, seed=7)).limit(2 * RANK_SAMPLE).collect())
    cuts = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []

    @F.pandas_udf("double")
    def rank(s: pd.Series) -> pd.Series:
        # spread over all n ranks: a column with few values would only have low bits, and never part the files
        return s.map(lambda v: float(bisect.bisect_right(cuts, v) * n // (len(cuts) + 1)), na_action="ignore").astype("float64")
    return F.coalesce(rank(F.col(c)), F.lit(0.0))


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = ZORDER_BITS,
               relative_error: float = 0.001) -> DataFrame:
    """Add ``_z``: Morton interleaving of per-column quantile-bucket indices."""
    n = 1 << bits
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in columns if c not in texts]
    out = df.withColumns({f"_zb_{c}": _string_rank(df, c, n) for c in texts})
    if numbers:
        out = out.withColumns({f"_zn_{c}": F.coalesce(_as_number(df, c), F.lit(float("-inf"))) for c in numbers})
        qs = out.approxQuantile([f"_zn_{c}" for c in numbers], [i / n for i in range(1, n)], relative_error)
        for c, q in zip(numbers, qs):
            splits = [float("-inf")] + sorted(set(v for v in q if math.isfinite(v))) + [float("inf")]
            out = Bucketizer(splits=splits, inputCol=f"_zn_{c}", outputCol=f"_zb_{c}", handleInvalid="keep").transform(out)
            out = out.withColumn(f"_zb_{c}", F.least(F.floor(F.col(f"_zb_{c}") * n / (len(splits) - 1)), F.lit(n - 1)))
    d = len(columns)
    z = F.lit(0).cast("long")
    for b in range(bits):
        for i, c in enumerate(columns):
            bit = F.shiftright(F.col(f"_zb_{c}").cast("long"), b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, b * d + i))
    return out.withColumn("_z", z).drop(*[f"_zn_{c}" for c in columns], *[f"_zb_{c}" for c in columns])


def folder_bytes(spark: SparkSession, path: str, glob: str = "*.parquet") -> int:
    """Total size of the data files below ``path``: a distributed file listing
    (``binaryFile`` without reading content), one row per file."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path))
    return int(files.agg(F.sum("length")).first()[0] or 0)


def zorder_compact(spark: SparkSession, path: str, columns: Sequence[str], new_path: str | None = None,
                   target_file_bytes: int = TARGET_FILE_BYTES, partition_by: Sequence[str] = (),
                   bloom: Mapping[str, int] | None = None) -> str:
    """Rewrite a Parquet folder clustered by the Z-order of ``columns`` into files
    of about ``target_file_bytes``; returns the new folder."""
    new_path = new_path or f"{path.rstrip('/')}-z{uuid.uuid4().hex[:8]}"
    _write_clustered(spark, [path], new_path, columns, target_file_bytes, partition_by, bloom)
    return new_path


def _write_clustered(spark: SparkSession, paths: Sequence[str], new_path: str, columns: Sequence[str], target_file_bytes: int,
                     partition_by: Sequence[str], bloom: Mapping[str, int] | None) -> None:
    df = spark.read.parquet(*paths)
    n_files = max(1, math.ceil(sum(folder_bytes(spark, p) for p in paths) / target_file_bytes))
    keyed = zorder_key(df, columns)
    # a tail that tells rows of one cell apart, so that a full cell can be cut into several files
    keyed = keyed.withColumn("_tail", F.xxhash64(*df.columns))
    out = keyed.repartitionByRange(n_files, *partition_by, "_z", "_tail").sortWithinPartitions(*partition_by, "_z").drop("_z", "_tail")
    w = out.write.mode("error").options(**bloom_filter_options(bloom or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(new_path)


def bloom_filters(spark: SparkSession, file: str) -> dict[str, int]:
    """Columns of a Parquet file that have a bloom filter in every row group, with the place of the first; read from the footer, through
    the file system that Spark uses."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf))
    try:
        found: dict[str, list[int]] = {}
        for block in reader.getFooter().getBlocks():
            for column in block.getColumns():
                found.setdefault(column.getPath().toDotString(), []).append(column.getBloomFilterOffset())
        return {c: offsets[0] for c, offsets in found.items() if min(offsets) > 0}
    finally:
        reader.close()


def rows_scanned(df: DataFrame) -> int:
    """Rows that the file scans of a collected DataFrame handed on: row groups that statistics, dictionaries or bloom filters rule
    out don't count. Runs the query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


class ClusteredTable:
    """L6/L7 kept up step by step: a table of parts, folders that are either loose (as appended) or clustered. ``live/v-<n>`` lists the
    parts, and its complete write is the commit; no file is changed afterwards, so readers and failed jobs leave each other alone.

    ``compact`` rewrites the loose parts only, into one more clustered part; what was clustered before isn't read. One writer per table."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], target_file_bytes: int = TARGET_FILE_BYTES,
                 bloom: Mapping[str, int] | None = None):
        self.spark, self.path, self.columns = spark, path.rstrip("/"), list(columns)
        self.target, self.bloom, self.folder = target_file_bytes, dict(bloom or {}), Folder(spark, self.path)

    def parts(self) -> dict[str, bool]:
        """Live parts, in the order they came, and whether each is clustered."""
        done = [v for v in self.folder.names("live") if self.folder.exists(f"live/{v}/_SUCCESS")]
        rows = self.spark.read.parquet(f"{self.path}/live/{done[-1]}").orderBy("at").collect() if done else []   # one row a part
        return {r["part"]: r["clustered"] for r in rows}

    def _commit(self, parts: Mapping[str, bool]) -> None:
        number = len(self.folder.names("live"))
        rows = [(i, p, c) for i, (p, c) in enumerate(parts.items())]
        self.spark.createDataFrame(rows, "at int, part string, clustered boolean").coalesce(1).write.parquet(f"{self.path}/live/v-{number:08d}")

    def append(self, df: DataFrame) -> None:
        part = f"loose-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{self.path}/{part}")
        self._commit({**self.parts(), part: False})

    def read(self) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.path}/{p}" for p in self.parts()))

    def compact(self) -> str | None:
        """Cluster the loose parts; the new part, or None if there was nothing to do."""
        parts = self.parts()
        loose = [p for p, clustered in parts.items() if not clustered]
        if not loose:
            return None
        fresh = f"z-{uuid.uuid4().hex[:12]}"
        _write_clustered(self.spark, [f"{self.path}/{p}" for p in loose], f"{self.path}/{fresh}", self.columns, self.target, (), self.bloom)
        self._commit({**{p: c for p, c in parts.items() if c}, fresh: True})
        return fresh
