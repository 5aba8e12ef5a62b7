"""Helpers registered for SQL use (``SELECT validate_json(payload) ...``)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .json_check import json_valid_strict


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the library's column helpers as SQL functions; returns their names.
    ``deterministic_id(a, b, ...)`` is a SQL macro-like built-in expression, so only the
    Python helpers need registering."""
    spark.udf.register("json_valid_strict", json_valid_strict)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION validate_json(t STRING) RETURNS STRING "
              "RETURN CASE WHEN t IS NULL THEN NULL WHEN json_valid_strict(t) THEN '' ELSE t END")
    return ["json_valid_strict", "validate_json"]
