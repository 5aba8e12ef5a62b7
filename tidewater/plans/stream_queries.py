"""Registered streaming queries.  Each stages Spark-derived input files in three
time-ordered chunks under a fresh folder of the shared checkpoint root, runs its query
``availableNow`` after every chunk (same checkpoint: incremental restarts), and returns
the sink read back as a batch DataFrame.  The oracle is the batch SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from .. import schemas as S
from ..operators import aggregates as agg
from ..operators import clean
from ..operators import stored
from ..session import scratch_dir
from ..sources import files, envelope as env
from ..sources import sinks
from ..sources.copy_into import copy_into, read_loaded
from ..sources.files import TS_FORMAT, stream_csv
from ..streaming import operators as so
from ..streaming.runner import run_stream
from ..streaming.staging import chunks, cut_times, stage
from . import registry as R
from . import sql as Q

TS = "MeasurementDateTime"


def _sp(spark) -> int:
    """State partitions of the test streams: the cluster's default parallelism."""
    return spark.sparkContext.defaultParallelism


def _silver_stream_source(spark, sf_dir, root):
    """Stage silver rows (event time as TIMESTAMP) as Parquet files; returns (path, schema)."""
    silver = so.as_event_time(R._silver(spark, sf_dir))
    path = f"{root}/input"
    return silver, path


# --------------------------------------------------------------------------- bronze from CSV
@R.register("stream_csv_bronze", Q.with_sensors(R.CLEAN_SQL))
def stream_csv_bronze(spark, sf_dir):
    """Raw CSV files arriving in three drops, cleaned by one
    incremental stream (restarted per drop) into a bronze folder with file lineage."""
    root = scratch_dir(spark, "csv-bronze")
    raw = R._raw(spark, sf_dir)
    schema = S.raw_sensor_schema()
    out, ckpt = f"{root}/bronze", f"{root}/_checkpoint"
    for _ in stage(raw, f"{root}/raw", TS, fmt="csv", options={"timestampFormat": TS_FORMAT}):
        src = stream_csv(spark, f"{root}/raw", schema, path_glob="*.csv")
        bronze = clean.with_lineage(clean.clean_raw(src))
        run_stream(bronze, ckpt, path=out, state_partitions=_sp(spark))
    df = spark.read.parquet(out)
    bad = df.filter(F.col("InputFileName").isNull()).limit(1).count()
    if bad:
        raise AssertionError("bronze rows without source file")
    return df.drop("InputFileName").withColumn(TS, F.col(TS).cast("timestamp_ntz"))


# --------------------------------------------------------------------------- fan-out
_FANOUT_SQL = ("SELECT 'all_sensors' AS table_name, " + Q.SILVER_COLS + " FROM sensors UNION ALL "
               + " UNION ALL ".join(f"SELECT '{n}' AS table_name, {Q.SILVER_COLS} FROM sensors WHERE SensorMeasurement = '{m}'"
                                    for n, m in S.DEFAULT_ROUTES.items()))


@R.register("route_fanout_stream", Q.with_sensors(_FANOUT_SQL))
def route_fanout_stream(spark, sf_dir):
    """K3/K4/K5/K9/X11: every micro-batch persisted once and written idempotently to the
    all-sensors table and one table per route (6 sinks)."""
    root = scratch_dir(spark, "fanout")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    ckpt, base = f"{root}/_checkpoint", f"{root}/tables"
    for _ in stage(silver, inp, TS):
        src = spark.readStream.schema(silver.schema).parquet(inp)
        run_stream(src, ckpt, foreach_batch=sinks.fanout_writer(base), state_partitions=_sp(spark))
    names = ["all_sensors", *S.DEFAULT_ROUTES]
    out = None
    for n in names:
        t = spark.read.parquet(f"{base}/{n}").drop(sinks.BATCH_COL).withColumn("table_name", F.lit(n))
        out = t if out is None else out.unionByName(t)
    return out.withColumn(TS, F.col(TS).cast("timestamp_ntz"))


# --------------------------------------------------------------------------- aggregates
@R.register("stream_agg_complete", Q.with_sensors(R.AGG_SQL))
def stream_agg_complete(spark, sf_dir):
    """Unwindowed streaming aggregate in complete mode; each trigger rewrites the
    result table (foreachBatch overwrite)."""
    root = scratch_dir(spark, "agg-complete")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    out, ckpt = f"{root}/totals", f"{root}/_checkpoint"

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(out)
    for _ in stage(silver, inp, TS):
        src = spark.readStream.schema(silver.schema).parquet(inp)
        run_stream(agg.sensor_totals(src), ckpt, foreach_batch=write, output_mode="complete",
                   state_partitions=_sp(spark))
    return spark.read.parquet(out)


@R.register("stream_agg_append", Q.with_sensors(
    "SELECT * FROM (" + R._window_sql(10, 5) + ") WHERE window_end <= "
    "(SELECT MAX(MeasurementDateTime) FROM sensors) - INTERVAL 10 MINUTE"))
def stream_agg_append(spark, sf_dir):
    """Sliding-window statistics with a 10-minute watermark in append mode: a
    window is written once, when the watermark passes its end (windows still open at
    the end of the input are not written)."""
    root = scratch_dir(spark, "agg-append")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    out, ckpt = f"{root}/windows", f"{root}/_checkpoint"
    for _ in stage(silver, inp, TS):
        src = spark.readStream.schema(silver.schema).parquet(inp)
        run_stream(so.windowed_stats(src, "10 minutes", "10 minutes", "5 minutes"), ckpt, path=out,
                   state_partitions=_sp(spark))
    df = spark.read.parquet(out)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@R.register("stream_dedup", Q.with_sensors(f"SELECT {Q.SILVER_COLS} FROM sensors"))
def stream_dedup(spark, sf_dir):
    """Every drop is delivered twice; de-duplication by Id within the watermark."""
    root = scratch_dir(spark, "dedup")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    doubled = silver.unionByName(silver)
    out, ckpt = f"{root}/dedup", f"{root}/_checkpoint"
    for _ in stage(doubled, inp, TS):
        src = spark.readStream.schema(silver.schema).parquet(inp)
        run_stream(so.dedup_within_watermark(src, ["Id"], TS, "1 hour"), ckpt, path=out, state_partitions=_sp(spark))
    return spark.read.parquet(out).withColumn(TS, F.col(TS).cast("timestamp_ntz"))


# --------------------------------------------------------------------------- merges
@R.register("stream_upsert", Q.with_sensors(
    "SELECT * FROM tgt WHERE Id NOT IN (SELECT Id FROM upd) UNION ALL SELECT * FROM upd", extra_ctes=R.MERGE_CTES))
def stream_upsert(spark, sf_dir):
    """Micro-batches merged by Id into a bucketed silver table (only touched
    buckets rewritten)."""
    root = scratch_dir(spark, "upsert")
    tgt, upd = R._merge_inputs(spark, sf_dir)
    table = stored.BucketedTable(spark, f"{root}/silver", ["Id"], n_buckets=16)
    table.upsert(tgt)
    ckpt, inp = f"{root}/_checkpoint", f"{root}/input"
    for _ in stage(upd, inp, TS):
        src = spark.readStream.schema(upd.schema).parquet(inp)
        run_stream(src, ckpt, foreach_batch=so.upsert_batches(table), state_partitions=_sp(spark))
    return table.read()


@R.register("stream_apply_changes", Q.with_sensors(
    "SELECT user_id, event_type, ts, value, props FROM ranked WHERE rn = 1 AND NOT is_delete",
    extra_ctes=R.CDC_FEED_SQL + ",\n" + R._LATEST))
def stream_apply_changes(spark, sf_dir):
    """A change feed applied per micro-batch to a bucketed SCD 1 table."""
    root = scratch_dir(spark, "cdc")
    feed = R._cdc_feed(spark, sf_dir)
    table = stored.BucketedTable(spark, f"{root}/silver", R.CDC_KEYS, n_buckets=16)
    ckpt, inp = f"{root}/_checkpoint", f"{root}/input"

    def apply(batch, batch_id):
        table.apply_changes(batch, sequence_by="ts", tiebreak=["event_id"], apply_as_deletes=R._DEL_COND,
                            except_column_list=["raw_value"])
    for _ in stage(feed, inp, "ts"):
        src = spark.readStream.schema(feed.schema).parquet(inp)
        run_stream(src, ckpt, foreach_batch=apply, state_partitions=_sp(spark))
    return table.read().drop("event_id")


_FEED_SQL = Q.with_sensors(
    "SELECT user_id, event_type, CASE WHEN NOT is_delete THEN ts END AS ts, CASE WHEN NOT is_delete THEN value END AS value, "
    "CASE WHEN is_delete THEN 'delete' WHEN COALESCE(was_deleted, TRUE) THEN 'insert' ELSE 'update' END AS _change, _commit "
    "FROM steps WHERE NOT (is_delete AND COALESCE(was_deleted, TRUE))",
    extra_ctes=R.CDC_FEED_SQL + ",\nspan AS (SELECT MIN(epoch_us(ts)) AS low, MAX(epoch_us(ts)) AS high FROM feed), "
    "dropped AS (SELECT feed.*, CASE WHEN epoch_us(ts) < low + (high - low) // 3 THEN 0 WHEN epoch_us(ts) < low + (high - low) * 2 // 3 THEN 1 ELSE 2 END::BIGINT AS _commit FROM feed, span), "
    "lasts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, _commit ORDER BY ts DESC, event_id DESC) AS k FROM dropped) WHERE k = 1), "
    "steps AS (SELECT *, lag(is_delete) OVER (PARTITION BY user_id, event_type ORDER BY _commit) AS was_deleted FROM lasts)")


@R.register("pipeline_change_feed", _FEED_SQL)
def pipeline_change_feed(spark, sf_dir):
    """A change target fed by three drops; a further table streams the target's change feed, run by run (inserted, updated and
    deleted keys of each merge). The target's files are never overwritten under that stream."""
    from .pipeline import Pipeline
    root = scratch_dir(spark, "change-feed")
    feed = R._cdc_feed(spark, sf_dir)
    p = Pipeline(spark, f"{root}/tables")
    p.table(name="changes")(lambda: spark.readStream.schema(feed.schema).parquet(f"{root}/in"))
    p.apply_changes(target="current", source="changes", keys=R.CDC_KEYS, sequence_by="ts", tiebreak=["event_id"], apply_as_deletes=R._DEL_COND, except_column_list=["raw_value"])
    p.table(name="log")(lambda: p.read_stream("current"))
    for _ in stage(feed, f"{root}/in", "ts"):
        p.run()
    return spark.read.parquet(p.path("log")).select(*R.CDC_KEYS, "ts", "value", "_change", F.col("_commit").cast("long").alias("_commit"))


# --------------------------------------------------------------------------- joins
_IJ_SQL = ("SELECT wt.Id AS Id, wt.SensorLocation AS SensorLocation, wt.MeasurementDateTime AS MeasurementDateTime, "
           "att.Id AS AirId, att.MeasurementDateTime AS AirTime FROM "
           f"(SELECT * FROM sensors WHERE SensorMeasurement = '{S.WATER_TEMP}') wt JOIN "
           f"(SELECT * FROM sensors WHERE SensorMeasurement = '{S.AIR_TEMP}') att "
           "ON att.SensorLocation = wt.SensorLocation AND att.MeasurementDateTime >= wt.MeasurementDateTime "
           "AND att.MeasurementDateTime <= wt.MeasurementDateTime + INTERVAL 2 MINUTE")


def _ij_sides(df):
    wt = fx.route(df, S.WATER_TEMP).select("Id", "SensorLocation", TS)
    att = fx.route(df, S.AIR_TEMP).select(F.col("Id").alias("AirId"), "SensorLocation", F.col(TS).alias("AirTime"))
    return wt, att


@R.register("interval_join", Q.with_sensors(_IJ_SQL))
def interval_join_batch(spark, sf_dir):
    """J13 (batch): air readings within 2 minutes after a water reading, same location,
    as a hash join on (location, minute bucket) plus the exact range filter."""
    wt, att = _ij_sides(R._silver(spark, sf_dir))
    return so.interval_join(wt, att, ["SensorLocation"], TS, "AirTime", 0, 120)


@R.register("stream_interval_join", Q.with_sensors(_IJ_SQL))
def stream_interval_join(spark, sf_dir):
    """Stream-stream inner join with watermarks on both sides and an event-time range."""
    root = scratch_dir(spark, "interval-join")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    out, ckpt = f"{root}/joined", f"{root}/_checkpoint"
    for _ in stage(silver, inp, TS):
        src = spark.readStream.schema(silver.schema).parquet(inp)
        wt, att = _ij_sides(src)
        j = so.interval_join(wt.withWatermark(TS, "10 minutes"), att.withWatermark("AirTime", "10 minutes"),
                             ["SensorLocation"], TS, "AirTime", 0, 120)
        run_stream(j, ckpt, path=out, state_partitions=_sp(spark))
    df = spark.read.parquet(out)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (TS, "AirTime")})


# --------------------------------------------------------------------------- envelope
@R.register("envelope_roundtrip", Q.with_sensors(f"SELECT {Q.SILVER_COLS} FROM sensors"))
def envelope_roundtrip(spark, sf_dir):
    """Records encoded as (key, JSON value) and stored, read back as a stream,
    unpacked from the envelope into bronze rows."""
    root = scratch_dir(spark, "envelope")
    silver = R._silver(spark, sf_dir).withColumn(TS, F.col(TS).cast("timestamp"))
    log, out, ckpt = f"{root}/log", f"{root}/bronze", f"{root}/_checkpoint"
    payload_schema = silver.schema
    for part in chunks(silver, TS):
        env.encode(part, "Id").write.mode("append").parquet(log)
        stream = files.stream_table(spark, path=log, schema=spark.read.parquet(log).schema)
        bronze = env.decode(env.to_envelope(stream), payload_schema)
        run_stream(bronze, ckpt, path=out, state_partitions=_sp(spark))
    return spark.read.parquet(out).withColumn(TS, F.col(TS).cast("timestamp_ntz"))


# --------------------------------------------------------------------------- COPY INTO
_COPY_SQL = ("SELECT MeasurementDateTime, CAST(SensorValue AS DOUBLE) AS SensorValue, SensorUnitDescription, "
             "SensorMeasurement, SensorLocation FROM sensors")


@R.register("copy_into_incremental", Q.with_sensors(_COPY_SQL))
def copy_into_incremental(spark, sf_dir):
    """Header-less CSV drops loaded into a staging table by position with
    try_cast; the load runs after every drop and once more at the end (no new files ->
    nothing appended)."""
    root = scratch_dir(spark, "copy-into")
    raw = R._silver(spark, sf_dir).select(
        F.lit("").alias("a"), F.lit("").alias("b"), F.lit("").alias("c"), F.lit("").alias("d"), F.lit("").alias("e"),
        F.date_format(TS, TS_FORMAT).alias("t"), F.col("SensorValue").cast("string").alias("v"),
        "SensorUnitDescription", "SensorMeasurement", "SensorLocation", F.col("Id").cast("string").alias("Id"))

    def select(df):
        return df.select(
            F.try_to_timestamp(F.col("_c5"), F.lit(TS_FORMAT)).alias(TS),
            F.expr("try_cast(_c6 AS DECIMAL(18,2))").alias("SensorValue"),
            F.col("_c7").alias("SensorUnitDescription"), F.col("_c8").alias("SensorMeasurement"),
            F.col("_c9").alias("SensorLocation"), F.col("_metadata.file_path").alias("InputFileName"))
    target, state = f"{root}/staging", f"{root}/_state"
    for _ in stage(raw.withColumn("_t", F.col("t")), f"{root}/raw", "_t", fmt="csv"):
        pass
    # files were staged with an extra column; load by position (11 columns + helper)
    copy_into(spark, f"{root}/raw", target, state, select, n_columns=12, pattern="*.csv")
    copy_into(spark, f"{root}/raw", target, state, select, n_columns=12, pattern="*.csv")
    return read_loaded(spark, target).drop("InputFileName").withColumn(TS, F.col(TS).cast("timestamp_ntz"))


# --------------------------------------------------------------------------- window join, sessions
_WJ_CTES = ("w AS (SELECT SensorLocation, time_bucket(INTERVAL 1 HOUR, MeasurementDateTime) AS window_start, "
            f"COUNT(*) FILTER (WHERE SensorMeasurement = '{S.WATER_TEMP}') AS left_count, "
            f"COUNT(*) FILTER (WHERE SensorMeasurement = '{S.AIR_TEMP}') AS right_count FROM sensors GROUP BY 1, 2), "
            f"lim AS (SELECT LEAST(MAX(MeasurementDateTime) FILTER (WHERE SensorMeasurement = '{S.WATER_TEMP}'), "
            f"MAX(MeasurementDateTime) FILTER (WHERE SensorMeasurement = '{S.AIR_TEMP}')) - INTERVAL 10 MINUTE AS wm "
            "FROM sensors)")
_WJ_SQL = Q.with_sensors(
    "SELECT SensorLocation, window_start, window_start + INTERVAL 1 HOUR AS window_end, left_count, right_count "
    "FROM w, lim WHERE left_count > 0 AND right_count > 0 AND window_start + INTERVAL 1 HOUR <= lim.wm",
    extra_ctes=_WJ_CTES)


@R.register("stream_window_join", _WJ_SQL)
def stream_window_join(spark, sf_dir):
    """Hourly counts of two streams (water temperature, air temperature), each
    finalised by its watermark, joined on (location, window) - chained stateful
    operators in append mode."""
    root = scratch_dir(spark, "window-join")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    out, ckpt = f"{root}/joined", f"{root}/_checkpoint"
    for _ in stage(silver, inp, TS):
        src = spark.readStream.schema(silver.schema).parquet(inp)
        left, right = fx.route(src, S.WATER_TEMP), fx.route(src, S.AIR_TEMP)
        run_stream(so.window_join(left, right, "1 hour", ["SensorLocation"], TS, "10 minutes"), ckpt, path=out,
                   state_partitions=_sp(spark))
    df = spark.read.parquet(out)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@R.register("stream_agg_session", Q.with_sensors(
    "SELECT * FROM (" + R.SESSION_SQL + ") WHERE session_end <= (SELECT MAX(MeasurementDateTime) FROM sensors) "
    "- INTERVAL 10 MINUTE"))
def stream_agg_session(spark, sf_dir):
    """Streaming session windows (30-minute gap) with a 10-minute watermark, merged per task
    before the shuffle; a session is written once the watermark passes its end."""
    root = scratch_dir(spark, "sessions")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    out, ckpt = f"{root}/sessions", f"{root}/_checkpoint"
    for _ in stage(silver, inp, TS):
        src = spark.readStream.schema(silver.schema).parquet(inp)
        run_stream(so.session_stream(src, "30 minutes", "10 minutes"), ckpt, path=out, state_partitions=_sp(spark), conf=so.SESSION_CONF)
    df = spark.read.parquet(out)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@R.register("stream_late_drop", R.ORACLES["stream_agg_append"])
def stream_late_drop(spark, sf_dir):
    """The last drop also re-delivers readings of the first days; they are older
    than the watermark of the previous micro-batch and are dropped, so the windows equal
    those of the on-time stream (a kept late copy would double-count an early window)."""
    from ..streaming.runner import dropped_by_watermark
    root = scratch_dir(spark, "late")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    parts = chunks(silver, TS)
    late = parts[0].filter(F.col(TS) < F.lit(cut_times(silver, TS, 6)[0]).cast("timestamp"))
    parts[-1] = parts[-1].unionByName(late)
    out, ckpt = f"{root}/windows", f"{root}/_checkpoint"
    dropped = 0
    for part in parts:
        part.write.mode("append").parquet(inp)
        src = spark.readStream.schema(silver.schema).parquet(inp)
        q = run_stream(so.windowed_stats(src, "10 minutes", "10 minutes", "5 minutes"), ckpt, path=out,
                     state_partitions=_sp(spark))
        dropped += dropped_by_watermark(q)
    if dropped == 0:
        raise AssertionError("late readings were not dropped")
    df = spark.read.parquet(out)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@R.register("stream_agg_update", Q.with_sensors(R.AGG_SQL))
def stream_agg_update(spark, sf_dir):
    """X7 update mode: each trigger emits only the groups whose statistics changed; they
    are merged by (location, measurement) into a bucketed table, which ends equal to the
    complete result."""
    root = scratch_dir(spark, "agg-update")
    silver, inp = _silver_stream_source(spark, sf_dir, root)
    table = stored.BucketedTable(spark, f"{root}/totals", ["SensorLocation", "SensorMeasurement"], n_buckets=4)
    ckpt = f"{root}/_checkpoint"

    def merge(batch, batch_id):
        table.upsert(batch)
    for _ in stage(silver, inp, TS):
        src = spark.readStream.schema(silver.schema).parquet(inp)
        run_stream(agg.sensor_totals(src), ckpt, foreach_batch=merge, output_mode="update",
                   state_partitions=_sp(spark))
    return table.read()
