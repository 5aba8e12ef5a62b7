"""CDC fixture of FIXTURES.md: any split of the rows into batches, in any order, gives
the same SCD 1 table; upserts and insert-only merges on a bucketed table."""
import itertools
import random
import re

import pytest

from tidewater.operators import merge as mg
from tidewater.operators import stored

ROWS = [(1, 1, "a", "I"), (1, 3, "c", "U"), (1, 2, "b", "U"), (2, 1, "x", "I"), (2, 2, None, "D"),
        (3, 1, "y", "I"), (3, 2, None, "U")]
SCHEMA = "key int, seq int, value string, op string"


def _apply(spark, batches, **kw):
    state = None
    for b in batches:
        df = spark.createDataFrame(b, SCHEMA)
        state = mg.apply_changes(state, df, ["key"], "seq", apply_as_deletes="op = 'D'",
                                 except_column_list=["op"], **kw)
    return {r["key"]: r["value"] for r in mg.visible(state).collect()}


def _splits(rows, seed):
    rnd = random.Random(seed)
    rows = rows[:]
    rnd.shuffle(rows)
    cuts = sorted(rnd.sample(range(1, len(rows)), rnd.randint(0, 3)))
    parts, last = [], 0
    for c in cuts + [len(rows)]:
        parts.append(rows[last:c])
        last = c
    return [p for p in parts if p]


def test_scd1_expected(spark):
    assert _apply(spark, [ROWS]) == {1: "c", 3: None}


def test_scd1_ignore_nulls_expected(spark):
    assert _apply(spark, [ROWS], ignore_null_updates=True) == {1: "c", 3: "y"}


@pytest.mark.parametrize("seed", range(4))
def test_any_batch_split_same_result(spark, seed):
    parts = _splits(ROWS, seed)
    assert _apply(spark, parts) == {1: "c", 3: None}
    assert _apply(spark, parts, ignore_null_updates=True) == {1: "c", 3: "y"}


def test_older_batch_after_delete_does_not_resurrect(spark):
    late_insert = [(2, 1, "x", "I")]
    assert _apply(spark, [[(2, 2, None, "D")], late_insert]) == {}


def test_truncate_persists_across_batches(spark):
    rows = [(1, 1, "a", "U"), (2, 5, "t", "T"), (3, 6, "z", "U")]
    state = None
    for b in ([rows[2]], [rows[1]], [rows[0]]):
        state = mg.apply_changes(state, spark.createDataFrame(b, SCHEMA), ["key"], "seq",
                                 apply_as_truncates="op = 'T'", except_column_list=["op"])
    assert {r["key"]: r["value"] for r in mg.visible(state).collect()} == {3: "z"}


def test_scd2_history(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    h = mg.scd2_history(df, ["key"], "seq", apply_as_deletes="op = 'D'").orderBy("key", "seq").collect()
    assert [(r["key"], r["seq"], r["__END_AT"]) for r in h] == [
        (1, 1, 2), (1, 2, 3), (1, 3, None), (2, 1, 2), (3, 1, 2), (3, 2, None)]


def test_bucketed_table_upsert_twice_equals_once(spark, tmp_path):
    t = stored.BucketedTable(spark, str(tmp_path / "silver"), ["Id"], n_buckets=4)
    base = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "Id int, v string")
    t.upsert(base)
    upd = spark.createDataFrame([(i, f"w{i}") for i in range(15, 25)], "Id int, v string")
    t.upsert(upd)
    once = sorted(map(tuple, t.read().collect()))
    t.upsert(upd)
    assert sorted(map(tuple, t.read().collect())) == once
    assert len(once) == 25 and dict(once)[16] == "w16" and dict(once)[3] == "v3"


def test_insert_only_keeps_existing(spark):
    tgt = spark.createDataFrame([(1, "a")], "Id int, v string")
    src = spark.createDataFrame([(1, "b"), (2, "c")], "Id int, v string")
    assert sorted(map(tuple, mg.insert_only(tgt, src, ["Id"]).collect())) == [(1, "a"), (2, "c")]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    from tidewater.sources import sinks
    p = str(tmp_path / "sink")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "Id int, v string")
    sinks.append_batch(df, p, 7)
    sinks.append_batch(spark.createDataFrame([(3, "c")], "Id int, v string"), p, 8)
    sinks.append_batch(df, p, 7)                          # replay of batch 7
    assert spark.read.parquet(p).count() == 3


def test_scd2_positions_equal_lead(spark, tmp_path):
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    rows = [(rnd.choice([1, 1, 1, 1, 2, 3]), i, f"v{i}", rnd.choice(["U", "U", "D"])) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = df.withColumn("__END_AT", F.lead("seq").over(Window.partitionBy("key").orderBy("seq"))).filter("op <> 'D'")
    b = mg.scd2_history(df, ["key"], "seq", apply_as_deletes="op = 'D'", num_partitions=7, work_dir=str(tmp_path / "pos"))
    cols = ["key", "seq", "value", "__END_AT"]
    assert sorted(map(tuple, a.select(cols).collect()), key=str) == sorted(map(tuple, b.select(cols).collect()), key=str)


def test_unreadable_file_raises_and_keeps_the_table(spark, tmp_path):
    t = stored.BucketedTable(spark, str(tmp_path / "t"), ["Id"], n_buckets=1, splits=1)
    t.upsert(spark.createDataFrame([(i, "v") for i in range(5)], "Id int, v string"))
    part = next((tmp_path / "t" / "rows").rglob("part-*"))
    part.with_name("part-broken.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        t.upsert(spark.createDataFrame([(9, "w")], "Id int, v string"))
    part.with_name("part-broken.parquet").unlink()
    assert t.read().count() == 5


def test_stored_upsert_needs_a_choice_between_duplicates(spark, tmp_path):
    t = stored.BucketedTable(spark, str(tmp_path / "t"), ["Id"])
    twice = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "Id int, seq int, v string")
    with pytest.raises(ValueError, match="one key"):
        t.upsert(twice)
    t.upsert(twice, sequence_by="seq")
    t.upsert(spark.createDataFrame([(1, 1, "late")], "Id int, seq int, v string"), sequence_by="seq")
    assert [tuple(r) for r in t.read().select("Id", "seq", "v").collect()] == [(1, 2, "b")]


def test_stored_truncate_empties_every_bucket(spark, tmp_path):
    t = stored.BucketedTable(spark, str(tmp_path / "t"), ["key"], n_buckets=4)
    kw = dict(sequence_by="seq", apply_as_truncates="op = 'T'", except_column_list=["op"])
    t.apply_changes(spark.createDataFrame([(i, 1, "a", "U") for i in range(20)], SCHEMA), **kw)
    t.apply_changes(spark.createDataFrame([(0, 5, None, "T")], SCHEMA), **kw)
    assert t.read().count() == 0
    t.apply_changes(spark.createDataFrame([(3, 4, "old", "U"), (4, 6, "new", "U")], SCHEMA), **kw)
    assert [(r.key, r.value) for r in t.read().collect()] == [(4, "new")]


# ---- stored tables: places, versions, change feed

def _place_dirs(path):
    return {p.parent for p in path.rglob("part-*")}


def test_a_batch_of_one_day_rewrites_that_day_only(spark, tmp_path):
    t = stored.BucketedTable(spark, str(tmp_path / "t"), ["Id", "day"], n_buckets=2, partition_by=["day"], splits=1)
    t.upsert(spark.createDataFrame([(i, f"d{i % 5}", 1, "a") for i in range(100)], "Id int, day string, seq int, v string"), sequence_by="seq")
    before = _place_dirs(tmp_path / "t" / "rows")
    t.upsert(spark.createDataFrame([(7, "d2", 2, "b"), (12, "d2", 0, "late")], "Id int, day string, seq int, v string"), sequence_by="seq")
    fresh = _place_dirs(tmp_path / "t" / "rows") - before
    assert fresh and all("day=d2" in str(p) for p in fresh)
    got = {r.Id: r.v for r in t.read().collect()}
    assert len(got) == 100 and got[7] == "b" and got[12] == "a"
    plan = t.read().filter("day = 'd2'")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: .*day#\d+ = d2.*dynamicpruning", plan)  # stale places and other days aren't read
    assert t.vacuum(keep=1) >= 1 and {r.Id: r.v for r in t.read().collect()} == got
    assert t.vacuum(keep=1) == 0


def test_a_merge_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    t = stored.BucketedTable(spark, str(tmp_path / "t"), ["Id"], n_buckets=3, feed=True)
    t.upsert(spark.createDataFrame([(i, 1, "a") for i in range(10)], "Id int, seq int, v string"), sequence_by="seq")
    update = spark.createDataFrame([(3, 2, "b"), (11, 2, "b")], "Id int, seq int, v string")
    read = t.read()
    with monkeypatch.context() as m:  # dies when rows and changes are written, before the heads
        m.setattr(stored, "MAX_PLACES", 0)
        with pytest.raises(ValueError):
            t.upsert(update, sequence_by="seq")
    assert t.read().count() == 10 and t.read().filter("v = 'b'").isEmpty() and t.read_changes().count() == 10
    with monkeypatch.context() as m:  # dies after the commit, before its changes are handed out
        m.setattr(stored.Folder, "move", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            t.upsert(update, sequence_by="seq")
    again = stored.BucketedTable(spark, str(tmp_path / "t"), ["Id"], n_buckets=3, feed=True)
    again.upsert(update, sequence_by="seq")  # the batch comes again
    assert again.read().count() == 11
    changes = [tuple(r) for r in again.read_changes().filter("_commit > 0").select("Id", "v", "_change").collect()]
    assert sorted(changes) == [(3, "b", "update"), (11, "b", "insert")]
    assert sorted(r.v for r in read.collect()) == ["a"] * 10  # a reader of the old version keeps its files


def test_change_feed_says_what_each_merge_did(spark, tmp_path):
    t = stored.BucketedTable(spark, str(tmp_path / "t"), ["key"], n_buckets=2, feed=True)
    kw = dict(sequence_by="seq", apply_as_deletes="op = 'D'", except_column_list=["op"])
    seen = []
    for batch in ([(1, 1, "a", "U"), (2, 1, "b", "U"), (3, 1, "c", "D")], [(1, 2, "a2", "U"), (2, 3, None, "D"), (4, 1, "d", "U")], [(2, 2, "late", "U"), (1, 2, "a2", "U")]):
        t.apply_changes(spark.createDataFrame(batch, SCHEMA), **kw)
        n = len(seen)
        seen.append(sorted((r.key, r["value"], r._change) for r in t.read_changes().filter(f"_commit = {n}").collect()))
    assert seen == [[(1, "a", "insert"), (2, "b", "insert")], [(1, "a2", "update"), (2, None, "delete"), (4, "d", "insert")], []]


def test_truncate_of_a_partitioned_table(spark, tmp_path):
    t = stored.BucketedTable(spark, str(tmp_path / "t"), ["key", "part"], n_buckets=2, partition_by=["part"])
    kw = dict(sequence_by="seq", apply_as_truncates="op = 'T'", except_column_list=["op"])
    schema = "key int, part string, seq int, value string, op string"
    t.apply_changes(spark.createDataFrame([(i, f"p{i % 3}", i, "a", "U") for i in range(12)], schema), **kw)
    t.apply_changes(spark.createDataFrame([(0, "p0", 8, None, "T")], schema), **kw)
    assert sorted(r.key for r in t.read().collect()) == [9, 10, 11]
    t.apply_changes(spark.createDataFrame([(1, "p1", 7, "old", "U"), (2, "p2", 20, "new", "U")], schema), **kw)  # the marker still holds
    assert sorted((r.key, r["value"]) for r in t.read().collect()) == [(2, "new"), (9, "a"), (10, "a"), (11, "a")]


@pytest.mark.parametrize("seed", range(3))
def test_stored_scd2_equals_the_whole_feed_for_any_split(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([1, 1, 2, 3]), i, f"v{i}", rnd.choice("UUD")) for i in range(60)]
    t = stored.Scd2Table(spark, str(tmp_path / "t"), ["key"], n_buckets=2, splits=1)
    for part in _splits(rows, seed + 10):
        t.apply(spark.createDataFrame(part, SCHEMA), "seq", apply_as_deletes="op = 'D'")
    t.apply(spark.createDataFrame(rows[:5], SCHEMA), "seq", apply_as_deletes="op = 'D'")  # delivered again
    cols = ["key", "seq", "value", "__START_AT", "__END_AT", "__IS_CURRENT"]
    whole = mg.scd2_history(spark.createDataFrame(rows, SCHEMA), ["key"], "seq", apply_as_deletes="op = 'D'")
    assert sorted(map(tuple, t.read().select(cols).collect()), key=str) == sorted(map(tuple, whole.select(cols).collect()), key=str)
