"""Mixing sources to target weights by weighted sampling without replacement (native DataFrame operations only).

Every document draws an exponential key divided by its quality weight, so that the order of the keys is a weighted
sample of any size. A source's word target is met by complete epochs first; the remainder is the prefix, in key
order, of one more. The prefix sum has two levels, so no task holds a source: keys fall into buckets that
keep their order, bucket totals are summed along each source, and documents are ordered inside a bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import WORD

BUCKETS = 4096  # a source's keys; a task orders one bucket of one source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sampling_key(ident: Column, weight: Column, seed: str = "mix") -> Column:
    """Exponential key of an id: -ln(u) / weight with u from the id's MD5, so that reruns agree."""
    digits = F.substring(F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("null")), F.lit(seed)).cast("binary")), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return -F.log(u) / weight


def word_targets(sizes: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Targets per source (columns ``source``, ``source_size``): shares of all words by weight, dealt in code-point order of
    the sources with null last; none above ``cap`` times its size, the excess going to the others by weight.

    min(cap * size, level * weight) with one level for all: sources are walked by cap per weight, and the level is
    the first at which the uncapped rest takes up what the capped ones leave. One row per source is windowed, no more."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    rows = rows.withColumn("most", cap * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    total = F.sum("source_size").over(Window.partitionBy())
    capped = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (total - capped) / open_)
    everywhere = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(everywhere)
    return rows.withColumn("target", F.coalesce(F.least("most", level * F.col("weight")), F.lit(0.0))).select("source", "source_size", "target")


def mix_sources(docs: DataFrame, keep: list[str], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                quality: Column | None = None, size: Column | None = None, cap: float = 3.0) -> DataFrame:
    """One row per input row: ``row`` (a struct of the columns in ``keep``), ``size`` (words), ``source_size``, ``target``, ``taken``
    (words the mix takes; a source's sum to its rounded target, the last document of the partial epoch in part) and
    ``copies`` (whole documents: that last one counts if its middle lies inside).

    ``quality`` is a positive weight (null: 1); ``size`` replaces the count of the text's words, so that no text need come along. A null text has size 0 and is never taken in words; a null source is a source
    of its own, the last by name; null ids share one key. Equal rows are documents of their own, next to each other
    in the order. An empty table gives an empty result; columns not named are ignored, whatever they are called.
    """
    size = word_count(F.col(text_col)) if size is None else size
    key = sampling_key(F.col(id_col), F.coalesce(quality, F.lit(1.0)) if quality is not None else F.lit(1.0))
    rows = docs.select(F.struct(*keep).alias("row"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key"), F.col(id_col).alias("id"))
    rows = rows.withColumn("bucket", F.least(F.lit(BUCKETS - 1), F.floor((1 - F.exp(-F.col("key"))) * BUCKETS)).cast("int"))
    cells = rows.groupBy("source", "bucket").agg(F.sum("size").alias("amount"))
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("amount").over(along), F.lit(0)))
    targets = word_targets(cells.groupBy("source").agg(F.sum("amount").alias("source_size")), cap).withColumnRenamed("source", "name")
    cells = cells.join(targets, F.col("source").eqNullSafe(F.col("name"))).select(F.col("source").alias("name"), F.col("bucket").alias("cell"), "before", "source_size", "target")
    joined = rows.join(cells, F.col("source").eqNullSafe(F.col("name")) & (F.col("bucket") == F.col("cell")))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    placed = joined.withColumn("start", start).withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("start")))
    whole = ((F.col("size") > 0) & (F.col("start") + F.col("size") / 2 <= F.col("rest"))).cast("long")
    return placed.select("row", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"), (F.col("epochs") + whole).cast("long").alias("copies"))


def with_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, Column]:
    """Documents with a weight column from labels (doc_id, quality): 2 if good, 1/2 if bad, 1 if not labelled (several labels: the best)."""
    name = "__quality"
    best = labels.groupBy(F.col("doc_id").alias("__labelled")).agg(F.max("quality").alias("__best"))
    weight = F.when(F.col("__best") == 1, F.lit(2.0)).when(F.col("__best") == 0, F.lit(0.5)).otherwise(F.lit(1.0))
    return docs.join(best, F.col(id_col) == F.col("__labelled"), "left").withColumn(name, weight).drop("__labelled", "__best"), F.col(name)
