"""Annotated CSV export, fixed schema, DECIMAL(10,0) trap, file metadata."""
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater import schemas as S
from tidewater.operators import clean
from tidewater.sources import files

ANNOTATED = """#group,false,false,true,true,false,false,true,true,true,
,result,table,_start,_stop,_time,_value,_field,_measurement,location,
,,0,2019-08-01T00:00:00Z,2019-09-17T21:36:00Z,2019-08-17T00:00:00Z,7.6,pH,h2o_pH,coyote_creek,
,,0,2019-08-01T00:00:00Z,2019-09-17T21:36:00Z,2019-08-17T00:12:00Z,7.4,pH,h2o_pH,santa_monica,
,,0,2019-08-01T00:00:00Z,2019-09-17T21:36:00Z,2019-08-17T00:18:00Z,,pH,h2o_pH,santa_monica,
"""


def _write(tmp_path, text, name="a.csv"):
    d = tmp_path / "raw"
    d.mkdir(exist_ok=True)
    (d / name).write_text(text)
    return str(d)


def _read(spark, path, precision):
    return spark.read.schema(S.raw_sensor_schema(reference_precision=precision)).option("header", "false").csv(path)


def test_annotated_header_rows_removed_by_clean(spark, tmp_path):
    path = _write(tmp_path, ANNOTATED)
    raw = _read(spark, path, True)
    rows = raw.collect()
    assert rows[0]["WindowAverageStartDateTime"] is None and rows[1]["WindowAverageStartDateTime"] is None
    out = clean.clean_raw(raw).orderBy("MeasurementDateTime").collect()
    assert [r["SensorValue"] for r in out] == [Decimal(8), Decimal(7)]        # (10,0) rounds
    assert "Skip" not in out[0].asDict()


def test_default_precision_keeps_fraction(spark, tmp_path):
    path = _write(tmp_path, ANNOTATED)
    out = clean.clean_raw(_read(spark, path, False)).orderBy("MeasurementDateTime").collect()
    assert [r["SensorValue"] for r in out] == [Decimal("7.60"), Decimal("7.40")]


def test_file_metadata_and_query_files(spark, tmp_path):
    path = _write(tmp_path, ANNOTATED)
    df = files.with_file_metadata(_read(spark, path, False))
    r = df.first()
    assert r["file_name"] == "a.csv" and r["file_size"] > 0 and r["InputFileName"].endswith("a.csv")
    assert files.query_files(spark, "csv", path).count() == 5


def test_stream_equals_batch(spark, tmp_path):
    from tidewater.streaming.runner import run, run_stream
    path = _write(tmp_path, ANNOTATED)
    schema = S.raw_sensor_schema()
    batch = run(clean.clean_raw, lambda: _read(spark, path, False), lambda: None, "static")
    stream = run(clean.clean_raw, lambda: None, lambda: files.stream_csv(spark, path, schema), "stream")
    out = str(tmp_path / "out")
    run_stream(stream, str(tmp_path / "ckpt"), path=out)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, batch.collect()))


def test_restart_reads_only_new_files(spark, tmp_path):
    from tidewater.streaming.runner import run_stream
    path = _write(tmp_path, ANNOTATED)
    schema = S.raw_sensor_schema()
    out, ck = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run_stream(clean.clean_raw(files.stream_csv(spark, path, schema)), ck, path=out)
    assert spark.read.parquet(out).count() == 2
    _write(tmp_path, ANNOTATED.replace("coyote_creek", "new_site"), "b.csv")
    run_stream(clean.clean_raw(files.stream_csv(spark, path, schema)), ck, path=out)
    df = spark.read.parquet(out)
    assert df.count() == 4 and df.filter(F.col("SensorLocation") == "new_site").count() == 1


def test_inferred_schema_empty_table_and_memory_sink(spark, tmp_path):
    from tidewater.streaming.runner import run_stream
    d = tmp_path / "inf"
    d.mkdir()
    (d / "x.csv").write_text("a,b\n1,2.5\n3,4.0\n")
    inferred = files.read_csv_inferred(spark, str(d))
    assert dict(inferred.dtypes) == {"a": "int", "b": "double"}
    empty = files.empty_table(spark, S.silver_schema())
    assert empty.count() == 0 and empty.schema == S.silver_schema()
    # once trigger into a memory sink (console/memory sinks are for inspection only)
    src = spark.readStream.schema(inferred.schema).option("header", "true").csv(str(d))
    q = run_stream(src, str(tmp_path / "ck"), fmt="memory", query_name="mem_once", trigger="once")
    assert spark.table("mem_once").count() == 2 and not q.isActive


def test_lineage_adds_file_and_ingest_time(spark, tmp_path):
    path = _write(tmp_path, ANNOTATED)
    out = clean.with_lineage(_read(spark, path, False), event_time="EventDateTime").first()
    assert out["InputFileName"].endswith("a.csv") and out["EventDateTime"] is not None


def test_create_table_if_absent(spark, tmp_path):
    name = "tw_src_test.silver_empty"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tw_src_test LOCATION '{tmp_path}/db'")
    assert files.create_table_if_absent(spark, name, S.silver_schema(), partition_by=["SensorMeasurement"])
    assert not files.create_table_if_absent(spark, name, S.silver_schema())
    assert spark.table(name).count() == 0
