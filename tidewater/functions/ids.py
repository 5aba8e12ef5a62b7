"""record ids.

The raw export's ``Id`` is replaced by a random uuid per row in the original notebooks;
every sink write of a micro-batch re-evaluated it, so ids never matched across tables.
``deterministic_id`` hashes the content instead, so replays and fan-out sinks agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(cols: Sequence[str | Column], ordinal: Column | None = None) -> Column:
    """SHA-256 of the columns' texts, each with its length in front (NULL: a dash), so that no two rows share an
    encoding whatever characters the values hold."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    parts = [part(F.col(c) if isinstance(c, str) else c) for c in cols]
    if ordinal is not None:
        parts.append(part(ordinal))
    return F.sha2(F.concat(*parts), 256)


def with_deterministic_id(df: DataFrame, cols: Sequence[str] | None = None, id_col: str = "Id",
                          chunk: int = 1 << 16) -> DataFrame:
    """Add ``id_col`` = sha256 of the row content plus the row's ordinal among exact
    duplicates, so n identical rows get n distinct, reproducible ids.

    Duplicates are counted by an aggregate (map-side combined) and re-expanded, first
    into chunks of ``chunk`` ordinals that are spread over tasks, then into rows, so even
    a content value repeated in a third of all rows is expanded in parallel.
    """
    cols = list(cols or [c for c in df.columns if c != id_col])
    rest = [c for c in df.columns if c not in cols and c != id_col]
    if rest:
        raise ValueError(f"columns {rest} are not part of the id; pass them in cols or drop them")
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    chunks = g.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / chunk))))
    chunks = chunks.repartition("_chunk", *cols)
    lo = F.col("_chunk") * chunk
    hi = F.least(F.col("_n"), lo + chunk) - 1
    rows = chunks.withColumn("_ord", F.explode(F.sequence(lo, hi))).drop("_chunk")
    return rows.withColumn(id_col, content_hash(cols, F.col("_ord"))).drop("_n", "_ord")


def uuid_column() -> Column:
    """Random uuid (dashed) as the built-in ``uuid()``; not reproducible - use for
    display only, never as a merge key."""
    return F.expr("uuid()")
