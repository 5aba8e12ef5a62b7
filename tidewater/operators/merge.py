"""Merges and change-data application (J3-J12) on plain Parquet.

The functions take the current table and a batch of changes as DataFrames and return the new
table; ``operators/stored.py`` applies them to tables kept on disk.

Conventions: keys must be non-NULL; ``sequence_by`` orders changes (higher wins, a change
that is older than the stored row loses); ``tiebreak`` columns order equal sequences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import session_conf
from .moving_average import latest_per_key

DELETED = "_deleted"


def _seq_list(sequence_by: str | Sequence[str]) -> list[str]:
    return [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           sequence_by: str | Sequence[str] | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """``MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *`` (SCD 1).
    With ``sequence_by`` the highest sequence of a key wins, among the updates and against the
    stored row (the update on a tie), as one aggregate with map-side combining; without it every
    update replaces the stored row, and keys must be unique in ``updates``."""
    if sequence_by:
        seq = _seq_list(sequence_by)
        both = target.withColumn("_new", F.lit(0)).unionByName(updates.select(*target.columns).withColumn("_new", F.lit(1)))
        return latest_per_key(both, keys, [*seq, "_new"], tiebreak).select(*target.columns)
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice (what MERGE does with an ambiguous source)."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"several rows for one key and no sequence_by to choose by: {[r.asDict() for r in twice]}")


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``MERGE ... WHEN NOT MATCHED INSERT *``: source rows whose key is not in the
    target are appended (all of them, as MERGE does)."""
    new = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def above_high_water(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows newer than the newest row already in the target
    (``WHERE c > (SELECT max(c) FROM target)``, a scalar subquery evaluated once; an
    empty target lets all rows through)."""
    hw = target.agg(F.max(column)).scalar()
    return source.filter(hw.isNull() | (F.col(column) > hw))


MARK = "_mark"


def with_mark(df: DataFrame, column: str) -> DataFrame:
    """The column as a whole number in ``_mark`` (microseconds for times): Parquet footers keep bounds of numbers, of times they don't."""
    c = F.col(column)
    return df.withColumn(MARK, F.unix_micros(c.cast("timestamp")) if "timestamp" in df.schema[column].dataType.simpleString() else c.cast("long"))


def stored_high_water(spark, path: str) -> int | None:
    """The largest mark of a stored table, from the footers of its files alone: Spark's Parquet scan answers the pushed
    aggregate without reading a row. ``path``: a table written with ``with_mark``; None if it is empty."""
    with session_conf(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        return marks(spark, path).first()[0]


def marks(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).agg(F.max(MARK))


def above_mark(source: DataFrame, column: str, mark: int | None) -> DataFrame:
    """Source rows above a table's high-water mark (all of them if it has none)."""
    return with_mark(source, column).filter(F.col(MARK) > F.lit(mark)).drop(MARK) if mark is not None else source


def _as_cond(c: str | Column | None) -> Column | None:
    if c is None:
        return None
    return F.expr(c) if isinstance(c, str) else c


def prepare_changes(changes: DataFrame, keys: Sequence[str], sequence_by: str | Sequence[str],
                    column_list: Sequence[str] | None = None, except_column_list: Sequence[str] | None = None,
                    apply_as_deletes: str | Column | None = None,
                    apply_as_truncates: str | Column | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Evaluate the delete/truncate conditions and select the tracked columns.
    Adds ``_op`` ('D' delete, 'T' truncate, 'U' upsert)."""
    seq = _seq_list(sequence_by) + list(tiebreak)
    d, t = _as_cond(apply_as_deletes), _as_cond(apply_as_truncates)
    op = F.lit("U")
    if d is not None:
        op = F.when(F.coalesce(d, F.lit(False)), F.lit("D")).otherwise(op)
    if t is not None:
        op = F.when(F.coalesce(t, F.lit(False)), F.lit("T")).otherwise(op)
    out = changes.withColumn("_op", op)
    if column_list is not None:
        keep = list(dict.fromkeys([*keys, *seq, *column_list]))
    else:
        keep = [c for c in changes.columns if c not in set(except_column_list or ()) or c in keys or c in seq]
    return out.select(*keep, "_op")


def apply_changes(target: DataFrame | None, changes: DataFrame, keys: Sequence[str],
                  sequence_by: str | Sequence[str], tiebreak: Sequence[str] = (),
                  ignore_null_updates: bool = False, apply_as_deletes: str | Column | None = None,
                  apply_as_truncates: str | Column | None = None,
                  column_list: Sequence[str] | None = None, except_column_list: Sequence[str] | None = None,
                  keep_tombstones: bool = True) -> DataFrame:
    """Apply a batch of change rows to a SCD 1 table.

    The returned table is a *state*: besides the columns it carries ``_deleted``
    (tombstones, so an older change in a later batch cannot bring a deleted key back),
    with ``ignore_null_updates`` the order of each column's last non-NULL value
    (``_o_<col>``) and of the key's last delete (``_del_o``), and with truncates a marker
    row (all keys NULL) holding the latest truncate.  Merging state and batch is then
    associative and commutative: any split of the changes into batches, applied in any
    order, gives the same table.  ``visible`` strips the bookkeeping.

    Work per batch: one aggregate over the changes (partial aggregation before the
    shuffle), one full outer join with the table on the keys, and one-row broadcasts for
    truncates.
    """
    seq = _seq_list(sequence_by) + [c for c in tiebreak if c not in _seq_list(sequence_by)]
    ch = prepare_changes(changes, keys, seq, column_list, except_column_list, apply_as_deletes, apply_as_truncates)
    values = [c for c in ch.columns if c not in keys and c not in seq and c != "_op"]
    order = F.struct(*[F.col(c) for c in seq])
    otype = ch.select(order.alias("o")).schema["o"].dataType
    book = [DELETED] + ([f"_o_{c}" for c in values] + ["_del_o"] if ignore_null_updates else [])

    if target is None:
        target = ch.limit(0).drop("_op")
    for c in book:
        if c not in target.columns:
            target = target.withColumn(c, F.lit(False) if c == DELETED else F.lit(None).cast(otype))
    target = target.select(*keys, *seq, *values, *book)
    is_marker = F.lit(True)
    for k in keys:
        is_marker = is_marker & F.col(k).isNull()

    if apply_as_truncates is not None:
        # latest truncate over the stored marker and this batch (scalar subquery)
        prev = target.filter(is_marker & F.col(seq[0]).isNotNull()).select(order.alias("_t"))
        cur = ch.filter(F.col("_op") == "T").select(order.alias("_t"))
        tmax_df = prev.unionByName(cur).agg(F.max("_t").alias("_tmax"))
        tmax = tmax_df.scalar()

        def after_truncate(df: DataFrame) -> DataFrame:
            return df.filter(tmax.isNull() | (order > tmax))
        ch = after_truncate(ch)
        target = after_truncate(target.filter(~is_marker))
        marker = tmax_df.filter(F.col("_tmax").isNotNull()).select(
            *[F.lit(None).cast(ch.schema[k].dataType).alias(k) for k in keys],
            *[F.col("_tmax").getField(c).alias(c) for c in seq],
            *[F.lit(None).cast(ch.schema[c].dataType).alias(c) for c in values],
            *[(F.lit(True) if c == DELETED else F.lit(None).cast(otype)).alias(c) for c in book])
    ch = ch.filter(F.col("_op") != "T")

    aggs = [F.max_by(F.struct(*[F.col(c) for c in seq + values] + [F.col("_op")]), order).alias("_w")]
    if ignore_null_updates:
        aggs.append(F.max(F.when(F.col("_op") == "D", order)).alias("_b_del"))
        for c in values:
            upd = (F.col("_op") == "U") & F.col(c).isNotNull()
            aggs.append(F.max_by(F.struct(order.alias("o"), F.col(c).alias("v")), F.when(upd, order)).alias(f"_nn_{c}"))
    grouped = ch.groupBy(*keys).agg(*aggs)
    win = grouped.select(*keys, *[F.col(f"_w.{c}").alias(f"_n_{c}") for c in seq + values],
                         F.col("_w._op").alias("_n_op"),
                         *([F.col("_b_del")] + [F.col(f"_nn_{c}") for c in values] if ignore_null_updates else []))

    j = target.alias("t").join(win.alias("n"), list(keys), "full_outer")
    t_order = F.struct(*[F.col(f"t.{c}") for c in seq])
    n_order = F.struct(*[F.col(f"_n_{c}") for c in seq])
    has_t = F.col(f"t.{DELETED}").isNotNull()
    has_n = F.col("_n_op").isNotNull()
    n_wins = has_n & (~has_t | (n_order >= t_order))    # the change wins unless the stored row is newer
    deleted = F.when(n_wins, F.col("_n_op") == "D").otherwise(F.col(f"t.{DELETED}"))

    out = [F.when(n_wins, F.col(f"_n_{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in seq]
    if not ignore_null_updates:
        for c in values:
            out.append(F.when(n_wins, F.when(F.col("_n_op") == "D", F.lit(None)).otherwise(F.col(f"_n_{c}")))
                        .otherwise(F.col(f"t.{c}")).alias(c))
        out.append(deleted.alias(DELETED))
    else:
        del_o = F.greatest(F.col("t._del_o"), F.col("_b_del"))
        tails = []
        for c in values:
            nn, t_o = F.col(f"_nn_{c}"), F.col(f"t._o_{c}")
            batch_newer = nn.isNotNull() & (t_o.isNull() | (nn.getField("o") > t_o))
            o = F.when(batch_newer, nn.getField("o")).otherwise(t_o)
            v = F.when(batch_newer, nn.getField("v")).otherwise(F.col(f"t.{c}"))
            alive = o.isNotNull() & (del_o.isNull() | (o > del_o))
            out.append(F.when(~deleted & alive, v).alias(c))
            tails.append(F.when(alive, o).alias(f"_o_{c}"))
        out.append(deleted.alias(DELETED))
        out += tails
        out.append(del_o.alias("_del_o"))
    res = j.select(*keys, *out)
    if apply_as_truncates is not None:
        res = res.unionByName(marker)
    if not keep_tombstones:
        res = visible(res)
    return res


def visible(table: DataFrame) -> DataFrame:
    """Rows of a change-applied table without tombstones and bookkeeping columns."""
    if DELETED not in table.columns:
        return table
    extra = [c for c in table.columns if c.startswith("_o_") or c == "_del_o"]
    return table.filter(~F.col(DELETED)).drop(DELETED, *extra)


START, END, CURRENT = "__START_AT", "__END_AT", "__IS_CURRENT"


def with_intervals(changes: DataFrame, keys: Sequence[str], sequence_by: str, tiebreak: Sequence[str] = (), **kw) -> DataFrame:
    """Change rows with ``__START_AT`` (their sequence) and ``__END_AT`` (the sequence of the key's next change, NULL for its last).

    The next change is found by global positions in (keys, sequence, tiebreak) order and an
    equi-join on position + 1: no task holds more than its range partition, however hot a key."""
    from .ordered import next_in_group, with_global_positions
    pos = with_global_positions(changes, [*keys, sequence_by, *tiebreak], **kw)
    closed = next_in_group(pos, keys, [sequence_by]).withColumnRenamed(f"_next_{sequence_by}", END).drop("_pos")
    return closed.withColumn(START, F.col(sequence_by))


def scd2_history(changes: DataFrame, keys: Sequence[str], sequence_by: str, tiebreak: Sequence[str] = (),
                 apply_as_deletes: str | Column | None = None, **kw) -> DataFrame:
    """SCD 2 history: every upsert becomes a version valid from its sequence until
    the next change of the key (``__END_AT`` NULL for the current one); a delete closes
    the open version without opening a new one."""
    d = _as_cond(apply_as_deletes)
    ch = changes.withColumn("_is_del", F.coalesce(d, F.lit(False)) if d is not None else F.lit(False))
    hist = with_intervals(ch, keys, sequence_by, tiebreak, **kw)
    return hist.filter(~F.col("_is_del")).withColumn(CURRENT, F.col(END).isNull()).drop("_is_del")
