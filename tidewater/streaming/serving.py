"""A stored forecast model served as a column of a stream.

Models are kept as rows (series, model as JSON) in versions of a folder; a retraining adds a version and never touches an older
one. Each micro-batch is joined with the newest complete version, so a stream that runs for weeks takes up a new model with
the next batch, and scored by an iterator pandas UDF that parses a model once per task.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import forecast as fc
from ..operators.stored import Folder
from ..sources import sinks


def model_rows(series: DataFrame, key: str = "ts_id") -> DataFrame:
    """Fitted models (``forecast.fit``) as rows: the series and ``model_json``."""
    fields = [F.unix_micros(F.col("start_time").cast("timestamp")).alias("start_us"), "intercept", "slope", "sigma", "season"]
    return fc.fit(series, key).select(key, F.to_json(F.struct(*fields)).alias("model_json"))


def store_models(models: DataFrame, path: str) -> str:
    """Add a version of the models; returns its folder. Only one job retrains at a time."""
    folder = Folder(models.sparkSession, path.rstrip("/"))
    number = 1 + max((int(n.split("-")[1]) for n in folder.names("") if n.startswith("v-")), default=-1)
    version = f"{folder.path}/v-{number:08d}-{uuid.uuid4().hex[:8]}"
    models.write.parquet(version)
    return version


def newest_models(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version of the models, None before the first."""
    folder = Folder(spark, path.rstrip("/"))
    done = [n for n in folder.names("") if n.startswith("v-") and folder.exists(f"{n}/_SUCCESS")]
    return spark.read.parquet(f"{folder.path}/{done[-1]}") if done else None


def _evaluate(parsed: dict, us: np.ndarray) -> np.ndarray:
    hours = us // 3_600_000_000 % 24
    season = np.array([parsed["season"].get(str(h), 0.0) for h in range(24)])
    return parsed["intercept"] + parsed["slope"] * ((us - parsed["start_us"]) / 3_600_000_000) + season[hours]


@F.pandas_udf(T.DoubleType())
def _predict(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    known: dict[str, dict] = {}  # models this task has met
    for model, us in parts:
        out = np.full(len(us), np.nan)
        for text, at in model.groupby(model).indices.items():
            if text not in known:
                known[text] = json.loads(text)
            out[at] = _evaluate(known[text], us.to_numpy()[at])
        yield pd.Series(out).where(model.notna().to_numpy() & ~np.isnan(out), None)


def predicted(model_json: Column, time: Column) -> Column:
    """The model's value at a time; NULL where there is no model."""
    return _predict(model_json, F.coalesce(F.unix_micros(time.cast("timestamp")), F.lit(0).cast("long")))


def with_prediction(df: DataFrame, models: DataFrame | None, key: str = "ts_id", time_col: str = "MeasurementDateTime", name: str = "yhat") -> DataFrame:
    """Rows with the prediction of their series' model as a column (NULL for series without one)."""
    if models is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    joined = df.join(models.select(key, "model_json"), key, "left")
    return joined.withColumn(name, F.when(F.col(time_col).isNotNull(), predicted(F.col("model_json"), F.col(time_col)))).drop("model_json")


def scoring_writer(models_path: str, out: str, key: str = "ts_id", time_col: str = "MeasurementDateTime") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that scores a micro-batch with the newest models and appends it, once per batch id."""
    def run(batch: DataFrame, batch_id: int) -> None:
        scored = with_prediction(batch, newest_models(batch.sparkSession, models_path), key, time_col)
        sinks.append_batch(scored, out, batch_id)
    return run
