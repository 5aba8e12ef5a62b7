"""Config, run parameters, SQL helpers, table DDL (LIKE drop, TRUNCATE after merge),
stream demultiplexing."""
import json

import pytest
from pyspark.sql import functions as F

from tidewater import config
from tidewater.operators import merge as mg
from tidewater.sources import envelope as env
from tidewater.sources import sinks


def test_json_config(spark, tmp_path):
    doc = {"RawToBronze": {"air_temp": "average_temperature", "water_ph": "h2o_pH"},
           "BronzeToSilver": {"air_temp": {"mergeKey": ["Id"], "sequenceBy": "MeasurementDateTime"}}}
    p = tmp_path / "cfg.json"
    p.write_text(json.dumps(doc, indent=2))
    routes, cdc = config.routes_from_config(config.read_json_config(spark, str(p)))
    assert routes["water_ph"] == "h2o_pH" and cdc["air_temp"]["keys"] == ["Id"]


def test_run_params(monkeypatch):
    monkeypatch.setenv("TIDEWATER_MODE", "static")
    monkeypatch.setenv("TIDEWATER_START_OVER", "yes")
    p = config.RunParams.from_env(file_name="a.csv")
    assert (p.mode, p.start_over, p.file_name) == ("static", True, "a.csv")
    monkeypatch.setenv("TIDEWATER_MODE", "sometimes")
    with pytest.raises(ValueError):
        config.RunParams.from_env()


def test_sql_functions(spark):
    from tidewater.functions.sql_udfs import register_sql_functions
    register_sql_functions(spark)
    r = spark.sql("SELECT validate_json('{\"a\":1}') AS ok, validate_json('{a') AS bad").first()
    assert (r.ok, r.bad) == ("", "{a")


def test_drop_like_and_truncate_after_merge(spark, tmp_path):
    db = "tw_ddl_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path}/{db}.db'")
    staging = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, None), (3, "2024-01-02 00:00:00")],
                                    "Id int, t string").withColumn("t", F.col("t").cast("timestamp"))
    staging.write.saveAsTable(f"{db}.bronze_staging")
    spark.createDataFrame([(1, None)], "Id int, t timestamp").write.saveAsTable(f"{db}.benchmark_a")
    target = spark.createDataFrame([(1, None)], "Id int, t timestamp")
    merged = mg.insert_only(target, spark.table(f"{db}.bronze_staging").filter(F.col("t").isNotNull()), ["Id"])
    assert sorted(r.Id for r in merged.collect()) == [1, 3]
    spark.sql(f"TRUNCATE TABLE {db}.bronze_staging")
    assert spark.table(f"{db}.bronze_staging").count() == 0
    assert sinks.drop_tables_like(spark, db, "benchmark%") == ["benchmark_a"]
    assert [t.name for t in spark.catalog.listTables(db)] == ["bronze_staging"]


def test_demultiplex_log(spark, tmp_path):
    rows = spark.createDataFrame([("1", "h2o_pH", 7.0), ("2", "average_temperature", 20.0), ("3", "h2o_pH", 6.5)],
                                 "Id string, SensorMeasurement string, SensorValue double")
    parts = env.demultiplex(env.encode(rows, "Id"), {"ph": "h2o_pH", "air": "average_temperature"}, rows.schema)
    assert sorted(r.Id for r in parts["ph"].collect()) == ["1", "3"]
    assert [r.SensorValue for r in parts["air"].collect()] == [20.0]
