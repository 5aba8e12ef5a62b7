"""Helpers shared by the text operators: loading, key handling, slicing of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import materialize

__all__ = ["NULL_IDS", "WORD", "byte_total", "keyed_texts", "load", "materialize", "slices"]

WORD = r"[^\x20\x09-\x0D]+"  # a word; bytes.split() cuts UTF-8 text at the same six characters
NULL_IDS = 1 << 62  # keys from here on stand for null ids; ids themselves are below
SLICE_BYTES = 1 << 21


BATCH_ROWS = 2000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table; from now on Arrow batches of the session hold BATCH_ROWS rows at most, as texts can be long (Spark
    keeps a batch outside its heap, twice while it grows)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the key (``order_key``) as ``doc`` and the text (null: empty) as ``txt``, whatever other columns there are."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(order_key(F.col(id_col), text).alias("doc"), text.alias("txt"))


def order_key(ident: Column, content: Column) -> Column:
    """The id; for a null one a number above all ids that follows from the row's content. So rows without an id come after all
    others and are documents of their own, but for equal ones."""
    return F.coalesce(ident.cast("long"), F.lit(NULL_IDS) + F.xxhash64(content).bitwiseAND(F.lit(NULL_IDS - 1)))


def shown_id(key: str, kind) -> Column:
    """The id of a key again, null where it stands for one."""
    return F.when(F.col(key) < NULL_IDS, F.col(key)).cast(kind)


def byte_total(texts: DataFrame) -> int:
    """UTF-8 bytes of all texts: one aggregate over the text column."""
    return texts.agg(F.sum(F.octet_length("txt"))).first()[0] or 0


def slices(batches: Iterator[pa.RecordBatch], text: str = "txt", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``limit`` bytes of text (one row at least): bounds a task's memory."""
    for b in batches:
        ends = pa.compute.cumulative_sum(pa.compute.fill_null(pa.compute.binary_length(b.column(text)), 0).cast(pa.int64())).to_pylist()
        start, base = 0, 0
        for i, e in enumerate(ends):
            if e - base >= limit or i + 1 == len(ends):
                yield b.slice(start, i + 1 - start)
                start, base = i + 1, e
