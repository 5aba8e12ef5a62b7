"""Declarative pipeline registry: build order follows reads, duplicate names and cycles
are refused, expectations and change targets apply."""
import pytest
from pyspark.sql import functions as F

from tidewater.plans.pipeline import Pipeline


def test_reads_order_and_expectations(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "t"))
    src = spark.createDataFrame([(1, 5.0), (2, None), (3, 1.0)], "Id int, v double")

    @p.table(name="gold", expect_all={"big": "n > 2"})
    def gold():                                # defined first, reads silver
        return p.read("silver").agg(F.count(F.lit(1)).alias("n"))

    @p.table(name="silver", expect_all_or_drop={"has_v": "v IS NOT NULL"})
    def silver():
        return src

    p.run()
    assert spark.read.parquet(p.path("silver")).count() == 2
    assert spark.read.parquet(p.path("gold")).first()["n"] == 2
    assert p.metrics["gold"].get["rows"] == 1 and p.metrics["gold"].get["failed_big"] == 1


def test_duplicate_name_and_cycle(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "t"))

    @p.table(name="a")
    def a():
        return p.read("b")

    @p.table(name="b")
    def b():
        return p.read("a")

    with pytest.raises(ValueError, match="defined twice"):
        @p.table(name="a")
        def a2():
            return None
    with pytest.raises(ValueError, match="cycle"):
        p.run()


def test_change_target_from_stream(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "t"))
    changes = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "x")], "Id int, seq int, v string")

    @p.table(name="bronze")
    def bronze():
        return changes

    p.apply_changes(target="silver", source="bronze", keys=["Id"], sequence_by="seq")
    p.run()
    got = {r.Id: r.v for r in p.read("silver").collect()}
    assert got == {1: "b", 2: "x"}


def test_stream_expectations_are_counted(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "t"))
    path = str(tmp_path / "in")
    spark.createDataFrame([(1, 5.0), (2, None), (3, 1.0)], "Id int, v double").repartition(3).write.parquet(path)

    @p.table(name="bronze", expect_all={"has_v": "v IS NOT NULL", "big": "v > 2"})
    def bronze():
        return spark.readStream.schema("Id int, v double").option("maxFilesPerTrigger", 1).parquet(path)

    p.run()
    assert spark.read.parquet(p.path("bronze")).count() == 3
    assert p.metrics["bronze"].get == {"rows": 3, "failed_has_v": 1, "failed_big": 2}


def test_zorder_of_long_common_prefixes_and_other_scripts(spark, tmp_path):
    from tidewater.operators import layout
    rows = [(i, f"h2o_temperature_{'abcdefgh'[i % 8]}", "漢字" * (i % 5 + 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "Id int, a string, b string")
    keyed = layout.zorder_key(df, ["a", "b"], bits=3).collect()
    assert len({(r.a, r.b) for r in keyed}) == len({r._z for r in keyed}) == 40
    df.write.parquet(str(tmp_path / "t"))
    out = layout.zorder_compact(spark, str(tmp_path / "t"), ["a", "b"], bloom={"Id": 400})
    assert sorted(r.Id for r in spark.read.parquet(out).collect()) == list(range(400))


def test_declared_schema_comment_and_properties_reach_the_catalog(spark, tmp_path):
    db = "tw_pipeline_test"
    p = Pipeline(spark, str(tmp_path / "t"), database=db)
    p.table(name="kept", schema="v double, day string", comment="it's kept", table_properties={"team": "a\\b"}, partition_cols=["day"])(
        lambda: spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, v int"))
    p.table(name="wrong", schema="v double")(lambda: spark.createDataFrame([(1, 2)], "v int, w int"))
    p.run(["kept"])
    p.run(["kept"])
    try:
        assert spark.table(f"{db}.kept").dtypes == [("v", "double"), ("day", "string")]
        assert sorted(map(tuple, spark.table(f"{db}.kept").collect())) == [(1.0, "d1"), (2.0, "d2")]
        told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.kept").select("col_name", "data_type").collect()}
        assert told["Comment"] == "it's kept" and "team=a\\b" in told["Table Properties"]
        with pytest.raises(ValueError, match="declared with"):
            p.run(["wrong"])
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
