"""Registered streams that fail, restart, run side by side or serve a model."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import forecast as fc
from ..operators import quality as q
from ..session import scratch_dir
from ..sources import envelope as env
from ..sources import files, sinks
from ..streaming import multiplex, serving
from ..streaming.runner import run_stream
from ..streaming.staging import chunks, stage
from . import registry as R
from . import sql as Q
from .stream_queries import _FANOUT_SQL, TS, _silver_stream_source, _sp


class _Lost(RuntimeError):
    """The failure that is put between two writes of a batch."""


@R.register("stream_restart", Q.with_sensors(_FANOUT_SQL))
def stream_restart(spark, sf_dir):
    """A fan-out stream whose driver is lost in the middle of the second micro-batch, when the all-rows table is written and
    two of the routes are not. The query starts again from its checkpoint and repeats the batch: nothing is lost, nothing doubled."""
    root = scratch_dir(spark, "restart")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    ckpt, base = f"{root}/_checkpoint", f"{root}/tables"
    some = dict(list(S.DEFAULT_ROUTES.items())[:-2])
    failures = 0

    def dying(batch, batch_id):
        sinks.fanout(batch, base, some if batch_id == 1 else S.DEFAULT_ROUTES, batch_id=batch_id)
        if batch_id == 1:
            raise _Lost("between two sinks")

    for _ in stage(silver, inp, TS):
        read = lambda: spark.readStream.schema(silver.schema).parquet(inp)
        try:
            run_stream(read(), ckpt, foreach_batch=dying if not failures else sinks.fanout_writer(base), state_partitions=_sp(spark))
        except PySparkException:
            failures += 1
            run_stream(read(), ckpt, foreach_batch=sinks.fanout_writer(base), state_partitions=_sp(spark))
    if failures != 1:
        raise AssertionError("the stream was to fail once")
    out = None
    for n in ["all_sensors", *S.DEFAULT_ROUTES]:
        t = spark.read.parquet(f"{base}/{n}").drop(sinks.BATCH_COL).withColumn("table_name", F.lit(n))
        out = t if out is None else out.unionByName(t)
    return out.withColumn(TS, F.col(TS).cast("timestamp_ntz"))


_LIMIT_SQL = f"(SELECT max(SensorValue) FROM sensors WHERE MeasurementDateTime < {Q.cut_sql(1)})"


@R.register("stream_expect_fail", Q.with_sensors(
    f"SELECT {Q.SILVER_COLS}, CAST(SensorValue AS DOUBLE) <= CAST({_LIMIT_SQL} AS DOUBLE) AS within FROM sensors "
    f"WHERE CAST(SensorValue AS DOUBLE) <= CAST({_LIMIT_SQL} AS DOUBLE) OR MeasurementDateTime >= {Q.cut_sql(2)}"))
def stream_expect_fail(spark, sf_dir):
    """Q2 on a stream: the rule (no value above those of the first drop) stops the query at the first row that breaks it, and the
    micro-batch writes nothing. The second drop then goes on from the same checkpoint with the bad rows left out, the last drop with the
    rule kept as a mark only."""
    root = scratch_dir(spark, "expect-fail")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    out, ckpt = f"{root}/out", f"{root}/_checkpoint"
    limit = None
    for i, part in enumerate(chunks(silver, TS)):
        part.write.mode("append").parquet(inp)
        if limit is None:
            limit = part.agg(F.max("SensorValue").cast("double")).first()[0]
        within = F.coalesce(F.col("SensorValue").cast("double") <= F.lit(limit), F.lit(False))
        rule = {"within_limit": within}
        read = lambda: spark.readStream.schema(silver.schema).parquet(inp).withColumn("within", within)  # noqa: E731,B023
        before = spark.read.parquet(out).count() if i else 0
        if i == 2:
            run_stream(read(), ckpt, path=out)
            continue
        try:
            run_stream(q.expect_or_fail(read(), rule), ckpt, path=out)
        except PySparkException as e:
            if "within_limit" not in str(e) or i == 0 or spark.read.parquet(out).count() != before:
                raise
            run_stream(q.expect_or_drop(read(), rule), ckpt, path=out)
    return spark.read.parquet(out).withColumn(TS, F.col(TS).cast("timestamp_ntz"))


_ROUTED_SQL = " UNION ALL ".join(f"SELECT '{n}' AS table_name, {Q.SILVER_COLS} FROM sensors WHERE SensorMeasurement = '{m}'" for n, m in S.DEFAULT_ROUTES.items())


@R.register("stream_demultiplex", Q.with_sensors(_ROUTED_SQL))
def stream_demultiplex(spark, sf_dir):
    """X11: one log of encoded records read by as many concurrent streams as there are routes, each with its own checkpoint. In the second
    drop one route fails and the others finish; with the third it catches up by itself."""
    root = scratch_dir(spark, "demultiplex")
    silver = R._silver(spark, sf_dir).withColumn(TS, F.col(TS).cast("timestamp"))
    log, base = f"{root}/log", f"{root}/routes"
    broken = next(iter(S.DEFAULT_ROUTES))

    def read_route(literal):
        records = env.decode(env.to_envelope(files.stream_table(spark, path=log, schema=spark.read.parquet(log).schema)), silver.schema)
        return records.filter(F.col("SensorMeasurement") == F.lit(literal))

    def fail(df, name):
        return df.withColumn("Id", F.raise_error(F.lit("lost")).cast("long")) if name == broken else df

    for i, part in enumerate(chunks(silver, TS)):
        env.encode(part, "Id").write.mode("append").parquet(log)
        running = multiplex.start_routes(read_route, S.DEFAULT_ROUTES, base, transform=fail if i == 1 else lambda df, name: df)
        try:
            running.wait(stop_on_failure=False)
        except multiplex.RoutesFailed as e:
            if i != 1 or set(e.errors) != {broken}:
                raise
    out = None
    for n in S.DEFAULT_ROUTES:
        t = spark.read.parquet(f"{base}/{n}").withColumn("table_name", F.lit(n))
        out = t if out is None else out.unionByName(t)
    return out.withColumn(TS, F.col(TS).cast("timestamp_ntz"))


def _scored_sql(i: int) -> str:
    """Readings of drop i with the value of the model that was fitted on all drops before."""
    until = f" AND MeasurementDateTime < {Q.cut_sql(i + 1)}" if i < 2 else ""
    return (f"SELECT n.Id, n.MeasurementDateTime, n.SensorMeasurement, CAST(n.SensorValue AS DOUBLE) AS SensorValue, round(p.intercept + p.slope * ((epoch_us(n.MeasurementDateTime) "
            f"- epoch_us(p.start_time)) / 3600000000.0) + COALESCE(f.season, 0.0), 6) AS yhat FROM (SELECT * FROM sensors WHERE MeasurementDateTime >= {Q.cut_sql(i)}{until}) n "
            f"LEFT JOIN (WITH past AS (SELECT * FROM sensors WHERE MeasurementDateTime < {Q.cut_sql(i)}), {Q.forecast_ctes('past')} SELECT * FROM params) p ON p.ts_id = n.SensorMeasurement "
            f"LEFT JOIN (WITH past AS (SELECT * FROM sensors WHERE MeasurementDateTime < {Q.cut_sql(i)}), {Q.forecast_ctes('past')} SELECT * FROM season) f "
            "ON f.ts_id = n.SensorMeasurement AND f.hr = hour(n.MeasurementDateTime)")


@R.register("stream_score_model", Q.with_sensors(
    f"SELECT Id, MeasurementDateTime, SensorMeasurement, CAST(SensorValue AS DOUBLE) AS SensorValue, CAST(NULL AS DOUBLE) AS yhat FROM sensors WHERE MeasurementDateTime < {Q.cut_sql(1)} "
    f"UNION ALL {_scored_sql(1)} UNION ALL {_scored_sql(2)}"))
def stream_score_model(spark, sf_dir):
    """Readings scored as they arrive, by the model stored last; after every drop the model is fitted anew on all readings so far and
    stored as a new version, which the running job takes up with its next batch."""
    root = scratch_dir(spark, "scoring")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    models, out, ckpt = f"{root}/models", f"{root}/scored", f"{root}/_checkpoint"
    rows = silver.select("Id", TS, "SensorMeasurement", "SensorValue")
    for _ in stage(rows, inp, TS):
        read = spark.readStream.schema(rows.schema).parquet(inp).withColumn("ts_id", F.col("SensorMeasurement"))
        run_stream(read, ckpt, foreach_batch=serving.scoring_writer(models, out), state_partitions=_sp(spark))
        serving.store_models(serving.model_rows(fc.hourly_series(spark.read.parquet(inp))), models)
    scored = spark.read.parquet(out).drop(sinks.BATCH_COL, "ts_id")
    return scored.withColumns({TS: F.col(TS).cast("timestamp_ntz"), "yhat": F.round("yhat", 6)})
