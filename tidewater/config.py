"""Pipeline configuration and run parameters.

Routes and change-data settings come from a JSON document (a file on the shared file
system, read with Spark) or a dict; run parameters come from arguments with an
environment fallback, so the same job runs scheduled or by hand.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import SparkSession

from . import schemas as S


def read_json_config(spark: SparkSession, path: str) -> dict:
    """Whole JSON document at ``path`` (one small file) as a dict."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return json.loads(text)


def routes_from_config(config: dict) -> tuple[dict[str, str], dict[str, dict]]:
    """(route -> sensor literal, route -> {keys, sequence_by}) from the pipeline config
    layout ``{"RawToBronze": {...}, "BronzeToSilver": {name: {"mergeKey": [...], "sequenceBy": c}}}``."""
    routes = dict(config.get("RawToBronze", S.DEFAULT_ROUTES))
    cdc = {name: {"keys": list(v.get("mergeKey", ["Id"])), "sequence_by": v.get("sequenceBy", "MeasurementDateTime")}
           for name, v in config.get("BronzeToSilver", {}).items()}
    return routes, cdc


@dataclass
class RunParams:
    """Run mode (static | stream), input location/file, start over, target root."""
    mode: str = "stream"
    source: str = ""
    file_name: str = ""
    start_over: bool = False
    target_root: str = ""

    @classmethod
    def from_env(cls, prefix: str = "TIDEWATER_", **overrides) -> RunParams:
        env = {k[len(prefix):].lower(): v for k, v in os.environ.items() if k.startswith(prefix)}
        vals = {f: env[f] for f in ("mode", "source", "file_name", "target_root") if f in env}
        if "start_over" in env:
            vals["start_over"] = env["start_over"].lower() in ("1", "true", "yes")
        vals.update({k: v for k, v in overrides.items() if v is not None})
        p = cls(**vals)
        if p.mode.lower() not in ("static", "batch", "stream"):
            raise ValueError(f"mode must be static or stream, not {p.mode!r}")
        return p
