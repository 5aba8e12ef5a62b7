"""Clustered files: ranges, sizes, incremental runs; bloom filters in footers and in use; footer aggregates."""
from pyspark.sql import functions as F

from tidewater.operators import layout
from tidewater.operators import merge as mg
from tidewater.session import session_conf


def _files(spark, path):
    return [r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path").collect()]


def _places(spark, n=60_000, places=30):
    return spark.range(n).select("id", F.format_string("place %02d", F.xxhash64("id") % 15 + places // 2).alias("place"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("v"))


def test_every_frequent_string_gets_its_own_rank(spark):
    df = spark.range(30 * 2000).select(F.format_string("place %02d", F.col("id") % 30).alias("place"), F.lit(0).alias("v"))
    assert layout.zorder_key(df, ["place"]).select("_z").distinct().count() == 30


def test_files_cover_small_ranges_of_both_columns(spark, tmp_path):
    df = _places(spark)
    df.repartition(12).write.parquet(str(tmp_path / "t"))
    size = layout.folder_bytes(spark, str(tmp_path / "t"))
    new = layout.zorder_compact(spark, str(tmp_path / "t"), ["place", "v"], target_file_bytes=size // 16)
    out = spark.read.parquet(new)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    spans = out.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("place").alias("places"), (F.max("v") - F.min("v")).alias("span"), F.count("*").alias("n")).collect()
    assert 12 <= len(spans) <= 20 and max(s.n for s in spans) <= 2.5 * 60_000 / len(spans)
    # unclustered, every file holds all 29 places and the whole span of v
    assert sum(s.places for s in spans) / len(spans) <= 15 and sum(s.span for s in spans) / len(spans) <= 600


def test_second_run_leaves_clustered_files_alone(spark, tmp_path):
    t = layout.ClusteredTable(spark, str(tmp_path / "t"), ["place", "v"])
    a, b = _places(spark, 2000), _places(spark, 3000).filter("id >= 2000")
    t.append(a.repartition(7))
    first = t.compact()
    before = {f: open(f.removeprefix("file:"), "rb").read() for f in _files(spark, f"{tmp_path}/t/{first}")}
    t.append(b.repartition(5))
    reader = t.read()
    second = t.compact()
    assert t.compact() is None and list(t.parts()) == [first, second]
    assert {f: open(f.removeprefix("file:"), "rb").read() for f in _files(spark, f"{tmp_path}/t/{first}")} == before
    assert t.read().count() == 3000 and reader.count() == 3000  # a reader of the loose files still finds them
    assert spark.read.parquet(f"{tmp_path}/t/{second}").count() == 1000


def test_bloom_filters_are_written_and_skip_row_groups(spark, tmp_path):
    ids = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("Id"), F.col("id").alias("v"))
    options = {"parquet.enable.dictionary": "false", "parquet.block.size": str(64 * 1024)}
    for name, bloom in (("with", layout.bloom_filter_options({"Id": 5000}, fpp=0.01)), ("without", {})):
        ids.repartition(8).write.options(**options, **bloom).parquet(str(tmp_path / name))
    assert all(set(layout.bloom_filters(spark, f)) == {"Id"} for f in _files(spark, str(tmp_path / "with")))
    assert all(not layout.bloom_filters(spark, f) for f in _files(spark, str(tmp_path / "without")))
    wanted = ids.filter("v = 12345").first().Id
    scanned = {n: layout.rows_scanned(spark.read.parquet(str(tmp_path / n)).filter(F.col("Id") == wanted)) for n in ("with", "without")}
    assert 1 <= scanned["with"] <= scanned["without"] / 3
    assert spark.read.parquet(str(tmp_path / "with")).filter(F.col("Id") == wanted).count() == 1


def test_high_water_reads_footers_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select("id", F.timestamp_seconds(F.col("id") * 7).cast("timestamp_ntz").alias("t"))
    mg.with_mark(df, "t").write.parquet(path)
    with session_conf(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        plan = mg.marks(spark, path)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedAggregation: [MAX(_mark)]" in plan
    mark = mg.stored_high_water(spark, path)
    assert mark == 999 * 7 * 1_000_000
    later = df.withColumn("t", F.col("t") + F.expr("INTERVAL 70 SECOND"))
    assert mg.above_mark(later, "t", mark).count() == 10
    mg.with_mark(df.limit(0), "t").write.parquet(f"{path}-empty")
    assert mg.stored_high_water(spark, f"{path}-empty") is None and mg.above_mark(later, "t", None).count() == 1000
