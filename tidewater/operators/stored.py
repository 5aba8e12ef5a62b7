"""Merge targets kept on disk (J3-J11): Parquet files whose live version is named by one small table.

Rows lie in *places*: a place holds the rows of one combination of partition values and one hash bucket of the keys, as
written by one merge (``rows/<partition columns>/_place=<bucket>.<partition hash>.<version>``). ``heads/v-<version>`` lists the live
place of each; its complete write is the commit. A merge

1. writes the batch once and finds the places it touches by a join with the heads (nothing is collected);
2. reads those places only (dynamic partition pruning), merges, and writes the result as new places - no file is ever overwritten, so
   running readers keep theirs, and a merge that dies leaves the table as it was, over all of its partitions;
3. with ``feed=True`` writes what changed, row by row, to ``pending``; 4. writes the new heads; 5. moves the pending changes to ``changes``,
   an append-only folder that streams read. A merge that died between 4 and 5 is completed by the next one.

So a batch of one day against a table partitioned by day reads and writes that day, whatever the table's size. One writer per table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import merge as mg
from .moving_average import latest_per_key

PLACE, CHANGE, COMMIT = "_place", "_change", "_commit"
BUCKET_BYTES = 512 * 1024 * 1024
MAX_PLACES = 1_000_000  # live places of a table: the heads that a reader broadcasts stay below some 100 MB


def bucket_of(keys: Sequence[str], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n_buckets)).cast("int")


class Folder:
    """What the table asks of its file system besides Spark's reads and writes. Only a missing path counts as missing; every other
    failure is raised."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._make = path, spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._make(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._make(f"{self.path}/{name}" if name else self.path))

    def names(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._make(f"{self.path}/{name}")))

    def make(self, name: str) -> None:
        self._fs.mkdirs(self._make(f"{self.path}/{name}"))

    def move(self, name: str, to: str) -> None:
        if not self._fs.rename(self._make(f"{self.path}/{name}"), self._make(f"{self.path}/{to}")):
            raise OSError(f"could not move {name} to {to} in {self.path}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._make(f"{self.path}/{name}"), True)


class BucketedTable:
    """A merge target with ``n_buckets`` hash buckets of the keys below ``partition_by`` columns, which must be among the keys, so that a key
    stays in its partition. The number of buckets belongs to the table: choose it from the bytes a partition is expected to hold (``for_size``);
    within a bucket several tasks write (``splits``)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], n_buckets: int = 64,
                 partition_by: Sequence[str] = (), splits: int = 4, feed: bool = False):
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be among the keys")
        self.spark, self.path, self.keys, self.n = spark, path.rstrip("/"), list(keys), n_buckets
        self.partition_by, self.splits, self.feed = list(partition_by), splits, feed
        self.folder = Folder(spark, self.path)

    @classmethod
    def for_size(cls, spark: SparkSession, path: str, keys: Sequence[str], expected_bytes: int, **kw) -> BucketedTable:
        """Buckets of about ``BUCKET_BYTES`` each."""
        return cls(spark, path, keys, n_buckets=max(4, -(-expected_bytes // BUCKET_BYTES)), **kw)

    # ---------------------------------------------------------------- versions
    def version(self) -> str | None:
        """Name of the last committed version (a number and a token of its merge)."""
        newest = reversed(self.folder.names("heads"))
        return next((v.removeprefix("v-") for v in newest if self.folder.exists(f"heads/{v}/_SUCCESS")), None)

    def exists(self) -> bool:
        return self.version() is not None

    def _base(self) -> Column:
        """The place of a row but for its version."""
        return F.concat_ws(".", bucket_of(self.keys, self.n).cast("string"), F.hex(F.xxhash64(*[F.col(c) for c in self.partition_by])) if self.partition_by else F.lit("0"))

    def _heads(self, version: str) -> DataFrame:
        # the comparison marks this side as a selective one, which dynamic partition pruning asks for
        return self.spark.read.parquet(f"{self.path}/heads/v-{version}").filter(F.col("base") >= "")

    def _rows(self, version: str, heads: DataFrame | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.path}/schema/v-{version}").first()[0]))
        rows = self.spark.read.schema(schema.add(PLACE, "string")).parquet(f"{self.path}/rows")
        live = F.broadcast((self._heads(version) if heads is None else heads).select(PLACE))  # MAX_PLACES rows at most
        return rows.join(live, PLACE, "left_semi").drop(PLACE)

    def read(self, with_tombstones: bool = False) -> DataFrame:
        version = self.version()
        if version is None:
            raise FileNotFoundError(f"no table at {self.path}")
        rows = self._rows(version)
        return rows if with_tombstones else mg.visible(rows)

    # ---------------------------------------------------------------- merging
    def _merge(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame | None], DataFrame], whole: Callable[[DataFrame], bool] | None = None) -> None:
        """Replace the places that the batch touches (all of them if ``whole`` says so of the batch) by ``combine(batch, their rows)``."""
        self._publish()
        batch, before = materialize(batch, "merge-batch"), self.version()
        number = 1 + int(before.split("-")[0]) if before else 0
        version = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        current = stale = kept = None
        if before:
            heads = self._heads(before)
            stale, kept = heads, None
            if whole is None or not whole(batch):
                places = batch.select(*self.keys).unionByName(self._extra_keys(batch)).select(self._base().alias("base")).distinct()
                stale, kept = heads.join(places, "base", "left_semi"), heads.join(places, "base", "left_anti")
            current = self._rows(before, stale)
        merged = combine(batch, current)
        schema = T.StructType([f for f in merged.schema if f.name not in self.partition_by] + [merged.schema[c] for c in self.partition_by])
        placed = merged.withColumn(PLACE, F.concat_ws(".", self._base(), F.lit(version)))
        part = F.pmod(F.hash(*[F.col(k) for k in self.keys]), F.lit(self.splits))
        self.folder.make("rows")
        placed.repartition(PLACE, part).write.mode("append").partitionBy(*self.partition_by, PLACE).parquet(f"{self.path}/rows")
        written = self.spark.read.schema(schema.add(PLACE, "string")).parquet(f"{self.path}/rows").filter(F.col(PLACE).endswith(version))
        if self.feed:
            self._changes(None if current is None else mg.visible(current), mg.visible(written.drop(PLACE))).write.parquet(f"{self.path}/pending/v-{version}")
        fresh = written.select(F.regexp_replace(PLACE, r"\.[^.]*$", "").alias("base"), PLACE).distinct()
        heads = materialize(fresh if kept is None else kept.unionByName(fresh), "heads").coalesce(1)
        if heads.count() > MAX_PLACES:
            raise ValueError(f"over {MAX_PLACES} places: choose fewer buckets or coarser partitions")
        names = T.StructType([f for f in schema if f.name != PLACE])
        self.spark.createDataFrame([(names.json(),)], "value string").coalesce(1).write.text(f"{self.path}/schema/v-{version}")
        heads.write.parquet(f"{self.path}/heads/v-{version}")
        self._publish()

    def _extra_keys(self, batch: DataFrame) -> DataFrame:
        """Keys whose places a merge reads besides the batch's own."""
        return batch.select(*self.keys).limit(0)

    def _changes(self, before: DataFrame | None, after: DataFrame) -> DataFrame:
        """Rows that a merge inserted, updated or deleted: after images (for a delete the key alone), with their kind."""
        values = [c for c in after.columns if c not in self.keys]
        new = after.select(*self.keys, F.struct(*values).alias("_n"))
        if before is None:
            return new.select(*self.keys, "_n.*", F.lit("insert").alias(CHANGE))
        old = before.select(*self.keys, F.struct(*values).alias("_o"))
        both = old.join(new, self.keys, "full_outer").filter(~F.col("_o").eqNullSafe(F.col("_n")))
        kind = F.when(F.col("_o").isNull(), "insert").when(F.col("_n").isNull(), "delete").otherwise("update")
        return both.select(*self.keys, "_n.*", kind.alias(CHANGE))

    def _publish(self) -> None:
        """Hand out the changes of the last committed merge, if that hasn't happened yet."""
        version = self.version()
        if self.feed and version and self.folder.exists(f"pending/v-{version}"):
            self.folder.make("changes")
            self.folder.move(f"pending/v-{version}", f"changes/{COMMIT}={int(version.split('-')[0])}")

    def upsert(self, batch: DataFrame, sequence_by=None, tiebreak=()) -> None:
        def combine(src: DataFrame, current: DataFrame | None) -> DataFrame:
            if not sequence_by:
                mg.require_unique(src, self.keys)
            if current is None:
                return latest_per_key(src, self.keys, sequence_by, tiebreak) if sequence_by else src
            return mg.upsert(current.select(*src.columns), src, self.keys, sequence_by, tiebreak)
        self._merge(batch, combine)

    def insert_only(self, batch: DataFrame) -> None:
        self._merge(batch, lambda src, current: src if current is None else mg.insert_only(current.select(*src.columns), src, self.keys))

    def apply_changes(self, batch: DataFrame, **kw) -> None:
        """J6-J10. Only a batch that holds a truncate reads the whole table; others read the marker of the last truncate and the places
        of their keys."""
        cut = mg._as_cond(kw.get("apply_as_truncates"))
        table = self if cut is None else _WithMarker(self)
        table._merge(batch, lambda src, current: mg.apply_changes(current, src, self.keys, keep_tombstones=True, **kw),
                     whole=None if cut is None else lambda src: not src.filter(cut).isEmpty())

    # ---------------------------------------------------------------- the change feed
    def read_changes(self, stream: bool = False) -> DataFrame:
        """The rows that merges changed, one row a change, with ``_change`` (insert, update, delete) and ``_commit`` (number of the merge); as a
        stream each merge's changes come once. Only for tables with ``feed=True`` and at least one merge."""
        self._publish()
        version = self.version()
        if not self.feed or version is None:
            raise FileNotFoundError(f"no change feed at {self.path}")
        schema = self.spark.read.parquet(f"{self.path}/changes").schema
        reader = self.spark.readStream if stream else self.spark.read
        return reader.schema(schema).parquet(f"{self.path}/changes")

    def vacuum(self, keep: int = 2) -> int:
        """Delete the files of places that none of the last ``keep`` versions names (no reader may still use older ones); their number."""
        done = [v.removeprefix("v-") for v in self.folder.names("heads") if self.folder.exists(f"heads/{v}/_SUCCESS")][-keep:]
        if not done:
            return 0
        live = None
        for v in done:
            live = self._heads(v).select(PLACE) if live is None else live.unionByName(self._heads(v).select(PLACE))
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{self.path}/rows").select("path")
        found = files.select(F.regexp_extract("path", r"/rows/(.*_place=[^/]+)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", r"_place=([^/]+)/", 1).alias(PLACE)).distinct()
        # places of merges that are newer than the last commit may belong to a running one
        old = found.join(live, PLACE, "left_anti").filter(F.regexp_extract(PLACE, r"\.(\d+)-[^.]*$", 1).cast("long") <= int(done[-1].split("-")[0]))
        dirs = [r["dir"] for r in old.select("dir").distinct().collect()]  # folders, not rows
        for d in dirs:
            self.folder.delete(f"rows/{d}")
        return len(dirs)


class _WithMarker(BucketedTable):
    """The same table for changes with truncates: the marker of the last truncate (all keys NULL) is read with every batch."""

    def __init__(self, table: BucketedTable):
        self.__dict__.update(table.__dict__)

    def _extra_keys(self, batch: DataFrame) -> DataFrame:
        types = batch.select(*self.keys).schema
        return self.spark.createDataFrame([tuple(None for _ in self.keys)], T.StructType([T.StructField(f.name, f.dataType) for f in types]))


class Scd2Table(BucketedTable):
    """The SCD 2 history as a stored table. Every change is kept, deletes too, with its validity interval, so a late change cuts the interval
    that it falls into, whichever batch brought it; only the keys of a batch get new intervals and only their places are rewritten."""

    def apply(self, batch: DataFrame, sequence_by: str, tiebreak: Sequence[str] = (), apply_as_deletes: str | Column | None = None) -> None:
        d = mg._as_cond(apply_as_deletes)
        marked = batch.withColumn("_is_del", F.coalesce(d, F.lit(False)) if d is not None else F.lit(False))

        def combine(src: DataFrame, current: DataFrame | None) -> DataFrame:
            if current is not None:
                touched = src.select(*self.keys).distinct()
                same, apart = current.join(touched, self.keys, "left_semi"), current.join(touched, self.keys, "left_anti")
                src = src.unionByName(same.select(*src.columns))
            # a change that is delivered again is the same change
            closed = mg.with_intervals(src.dropDuplicates([*self.keys, sequence_by, *tiebreak]), self.keys, sequence_by, tiebreak)
            return closed if current is None else closed.unionByName(apart.select(*closed.columns))
        self._merge(marked, combine)

    def read(self, with_tombstones: bool = False) -> DataFrame:
        rows = super().read(with_tombstones=True)
        return rows if with_tombstones else rows.filter(~F.col("_is_del")).withColumn(mg.CURRENT, F.col(mg.END).isNull()).drop("_is_del")
