"""Declarative pipeline registry (D1-D6): tables defined by functions.

    p = Pipeline(spark, root)

    @p.table(name="bronze", expect_all_or_drop={...})
    def bronze():
        return p.read_stream_files(...)          # any DataFrame, batch or streaming

    @p.table(name="gold")
    def gold():
        return p.read("bronze").groupBy(...).agg(...)

    p.apply_changes(target="silver", source="bronze", keys=["Id"], sequence_by="ts")
    p.run()

Tables are registered under their ``name`` (several functions may share a Python name).
``run`` materialises every table into ``root/<name>``; a table is built when first read,
so the order follows the reads (a cycle raises).  A function returning a streaming
DataFrame becomes an incremental table (``availableNow`` with its own checkpoint under
``root/_checkpoints``); ``read_stream`` of a materialised table streams its files, that of a
change target its change feed.
Expectations are applied as in ``tidewater.operators.quality``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as q
from ..operators import stored
from ..streaming.runner import run_stream


@dataclass
class TableSpec:
    name: str
    fn: Callable[[], DataFrame] | None
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)
    expect_all_or_drop: Mapping[str, str] = field(default_factory=dict)
    expect_all_or_fail: Mapping[str, str] = field(default_factory=dict)
    expect_all: Mapping[str, str] = field(default_factory=dict)
    partition_cols: Sequence[str] = ()
    schema: T.StructType | None = None
    cdc: dict | None = None


class Pipeline:
    def __init__(self, spark: SparkSession, root: str, conf: Mapping[str, str] | None = None, database: str | None = None):
        self.spark, self.root, self.database = spark, root.rstrip("/"), database
        self.conf = dict(conf or {})
        self.specs: dict[str, TableSpec] = {}
        self._state: dict[str, str] = {}      # name -> "building" | "done"
        self.metrics: dict[str, dict] = {}

    # ---------------------------------------------------------------- definition
    def table(self, name: str | None = None, comment: str = "", table_properties: Mapping[str, str] | None = None,
              expect_all_or_drop: Mapping[str, str] | None = None, expect_all_or_fail: Mapping[str, str] | None = None,
              expect_all: Mapping[str, str] | None = None, partition_cols: Sequence[str] = (),
              schema: T.StructType | str | None = None):
        """Declare a table. With a ``database`` the table is entered in its catalog under its name, with comment, properties and
        partitions. ``schema`` (a StructType or DDL) is what the table must have: its columns are cast to it, missing or further ones are an error."""
        declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

        def deco(fn):
            n = name or fn.__name__
            if n in self.specs:
                raise ValueError(f"table {n} defined twice")
            self.specs[n] = TableSpec(n, fn, comment, dict(table_properties or {}), dict(expect_all_or_drop or {}),
                                      dict(expect_all_or_fail or {}), dict(expect_all or {}), tuple(partition_cols), declared)
            return fn
        return deco

    def apply_changes(self, target: str, source: str, keys: Sequence[str], sequence_by: str, expected_bytes: int = 0,
                      partition_cols: Sequence[str] = (), **options) -> None:
        """D3: a SCD 1 target kept from a change source (J6-J10 options pass through), in buckets for ``expected_bytes`` of rows
        in a partition. Every micro-batch rewrites the places that it touches and appends what changed to the target's feed."""
        self.specs[target] = TableSpec(target, None, partition_cols=tuple(partition_cols),
                                       cdc=dict(source=source, keys=list(keys), sequence_by=sequence_by, bytes=expected_bytes, options=options))

    # ---------------------------------------------------------------- reading
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """Batch read of another table of the pipeline (built first if needed)."""
        self._build(name)
        cdc = self.specs[name].cdc
        if cdc is None:
            return self.spark.read.parquet(self.path(name))
        table = self.change_target(name)
        return table.read() if table.exists() else self.read(cdc["source"]).limit(0)

    def read_stream(self, name: str) -> DataFrame:
        """Incremental read of another table of the pipeline: its files as a stream, or for a change target the rows that
        each of its micro-batches changed (``_change``, ``_commit``); no file that a stream may read is ever overwritten."""
        self._build(name)
        if self.specs[name].cdc is not None:
            return self.change_target(name).read_changes(stream=True)
        schema = self.spark.read.parquet(self.path(name)).schema
        return self.spark.readStream.schema(schema).parquet(self.path(name))

    # ---------------------------------------------------------------- running
    def run(self, tables: Sequence[str] | None = None) -> dict[str, str]:
        self._state.clear()
        for n in tables or list(self.specs):
            self._build(n)
        return {n: self.path(n) for n in self.specs}

    def _build(self, name: str) -> None:
        st = self._state.get(name)
        if st == "done":
            return
        if st == "building":
            raise ValueError(f"cycle through table {name}")
        if name not in self.specs:
            raise KeyError(f"unknown table {name}")
        self._state[name] = "building"
        spec = self.specs[name]
        if spec.cdc is not None:
            self._build_cdc(spec)
        else:
            df = spec.fn()
            if spec.schema is not None:
                if set(df.columns) != set(spec.schema.names):
                    raise ValueError(f"table {name} is declared with columns {spec.schema.names}, its query has {df.columns}")
                df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in spec.schema])
            if spec.expect_all_or_drop:
                df = q.expect_or_drop(df, spec.expect_all_or_drop)
            if spec.expect_all_or_fail:
                df = q.expect_or_fail(df, spec.expect_all_or_fail)
            if spec.expect_all:
                df, self.metrics[name] = q.expect(df, spec.expect_all, name)
            if df.isStreaming:
                query = run_stream(df, f"{self.root}/_checkpoints/{name}", path=self.path(name),
                                   partition_by=spec.partition_cols or None)
                if spec.expect_all:
                    self.metrics[name] = q.StreamCounts(query, name)
            else:
                w = df.write.mode("overwrite")
                if spec.partition_cols:
                    w = w.partitionBy(*spec.partition_cols)
                w.parquet(self.path(name))
            if self.database:
                self._enter(spec, df.schema)
        self._state[name] = "done"

    def _enter(self, spec: TableSpec, schema: T.StructType) -> None:
        """Enter a built table in the catalog, anew if its entry differs; the files stay where they are."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        full = f"{self.database}.{spec.name}"
        self.spark.sql(f"DROP TABLE IF EXISTS {full}")   # external: only the entry goes
        quoted = lambda text: "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in spec.partition_cols)})" if spec.partition_cols else ""
        comment = f" COMMENT {quoted(spec.comment)}" if spec.comment else ""
        props = f" TBLPROPERTIES ({', '.join(f'{quoted(k)} = {quoted(v)}' for k, v in spec.properties.items())})" if spec.properties else ""
        self.spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet{parts} LOCATION {quoted(self.path(spec.name))}{comment}{props}")
        if spec.partition_cols:
            self.spark.catalog.recoverPartitions(full)

    def change_target(self, name: str) -> stored.BucketedTable:
        spec = self.specs[name]
        return stored.BucketedTable.for_size(self.spark, self.path(name), spec.cdc["keys"], spec.cdc["bytes"], partition_by=spec.partition_cols, feed=True)

    def _build_cdc(self, spec: TableSpec) -> None:
        c, table = spec.cdc, self.change_target(spec.name)
        src = self.read_stream(c["source"])

        def apply(batch: DataFrame, batch_id: int) -> None:
            table.apply_changes(batch, sequence_by=c["sequence_by"], **c["options"])
        run_stream(src, f"{self.root}/_checkpoints/{spec.name}", foreach_batch=apply)
