"""Registered queries: name -> (spark builder, oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a DataFrame over the driver's tables;
``__spark_entry__`` exposes them.  Output columns use plain types (decimals as DOUBLE,
timestamps without zone) so the DuckDB oracle can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as fx
from .. import schemas as S
from ..functions import ids
from ..functions import json_check as jc
from ..operators import aggregates as agg
from ..operators import clean
from ..operators import forecast as fc
from ..operators import merge as mg
from ..operators import quality as qual
from ..operators import stored
from ..operators.moving_average import latest_per_key, moving_average
from ..session import ensure_session_conf, materialize, scratch_dir
from ..streaming.staging import cut_times
from . import gold
from . import sql as Q

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals -> DOUBLE, zoned timestamps -> TIMESTAMP_NTZ (UTC session)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session_conf(spark)
            return plain_types(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


def _silver(spark, sf_dir, hourly=False):
    return fx.sensors(spark, sf_dir, hourly=hourly).select(
        "Id", "MeasurementDateTime", "SensorValue", "SensorUnitDescription", "SensorMeasurement", "SensorLocation")


# --------------------------------------------------------------------------- W1-W5
@register("ma_water_quality", Q.with_sensors(Q.ma_select(gold.WATER_FRAMES, where=f"SensorMeasurement = '{S.WATER_QUALITY}'")))
def ma_water_quality(spark, sf_dir):
    """Short (31 rows) and long (366 rows) moving average of water quality."""
    return gold.ma_table(_silver(spark, sf_dir), S.WATER_QUALITY, gold.WATER_FRAMES)


@register("ma_air_temp", Q.with_sensors(Q.ma_select(gold.AIR_FRAMES, where=f"SensorMeasurement = '{S.AIR_TEMP}'")))
def ma_air_temp(spark, sf_dir):
    """The air-temperature gold table from the all-sensors silver table."""
    return gold.ma_table(_silver(spark, sf_dir), S.AIR_TEMP, gold.AIR_FRAMES)


@register("ma_all_series", Q.with_sensors(Q.ma_select(gold.AIR_FRAMES, partition="PARTITION BY SensorMeasurement, SensorLocation")))
def ma_all_series(spark, sf_dir):
    """Every (measurement, location) series in one pass."""
    return moving_average(_silver(spark, sf_dir), frames=gold.AIR_FRAMES,
                          partition_by=("SensorMeasurement", "SensorLocation"))


@register("ma_halo", Q.with_sensors(Q.ma_select(gold.AIR_FRAMES, partition="PARTITION BY SensorMeasurement")))
def ma_halo(spark, sf_dir):
    """The distributed (range partition + halo bucket) form with many small buckets, on every sensor."""
    return moving_average(_silver(spark, sf_dir), frames=gold.AIR_FRAMES, partition_by=("SensorMeasurement",),
                          bucket_rows=4096)


# --------------------------------------------------------------------------- forecast
def _forecast_rows(spark, sf_dir):
    return gold.silver_hourly_forecast(_silver(spark, sf_dir))


@register("forecast_predict", Q.with_sensors(
    "SELECT SensorMeasurement, ds, round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, "
    "round(yhat_upper, 6) AS yhat_upper FROM fc",
    extra_ctes=Q.forecast_future_sql().rstrip() + f",\nfc AS ({Q.forecast_rows_sql()})"))
def forecast_predict(spark, sf_dir):
    """24 hourly forecast steps per sensor with a 95 % band."""
    out = _forecast_rows(spark, sf_dir)
    return out.select("SensorMeasurement", "ds", *[F.round(c, 6).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


@register("forecast_metrics", Q.with_sensors(Q.METRICS_SELECT, extra_ctes=Q.metrics_sql().rstrip()))
def forecast_metrics(spark, sf_dir):
    """Hold out the last 24 hours of each series, fit on the rest, score."""
    m = fc.evaluate(fc.hourly_series(_silver(spark, sf_dir)))
    return m.select("ts_id", *[F.round(c, 6).alias(c) for c in fc.METRICS])


@register("water_quality_forecast", Q.with_sensors(
    "SELECT MeasurementDateTime, ValueType, round(SensorValue, 6) AS SensorValue FROM water_quality_forecast",
    extra_ctes=Q.water_quality_forecast_ctes()))
def water_quality_forecast(spark, sf_dir):
    """Latest 1000 points of actuals UNION forecast for water quality."""
    silver = _silver(spark, sf_dir)
    g = gold.ma_table(silver, S.WATER_QUALITY, gold.WATER_FRAMES)
    v = gold.water_quality_forecast(g, gold.silver_hourly_forecast(silver))
    return v.withColumn("SensorValue", F.round("SensorValue", 6))


# --------------------------------------------------------------------------- gold daily
def _gold_daily(spark, sf_dir, hourly, keep_fanout=True, with_forecast=True):
    silver = _silver(spark, sf_dir, hourly=hourly)
    verified = {col: (lit, fx.route(silver, lit)) for col, lit in gold.VERIFIED_COLUMNS.items()}
    view = None
    if with_forecast:
        # the overlay view is built from the (unhourly) silver table, as in the SQL text
        base = _silver(spark, sf_dir, hourly=hourly)
        g = gold.ma_table(base, S.WATER_QUALITY, gold.WATER_FRAMES)
        view = gold.water_quality_forecast(g, gold.silver_hourly_forecast(base))
    return gold.gold_daily(silver, verified, view, keep_join_fanout=keep_fanout)


@register("gold_daily", Q.gold_daily_sql(gold.VERIFIED_COLUMNS))
def gold_daily(spark, sf_dir):
    """The benchmark's daily gold aggregate, exact SQL meaning."""
    return _gold_daily(spark, sf_dir, hourly=False)


@register("gold_daily_hourly", Q.gold_daily_sql(gold.VERIFIED_COLUMNS, hourly=True))
def gold_daily_hourly(spark, sf_dir):
    """gold_daily on hour-truncated times: ties and join fan-out (21k joined rows at sf0.01)
    computed without materialising the joined pairs."""
    return _gold_daily(spark, sf_dir, hourly=True)


# --------------------------------------------------------------------------- aggregates
AGG_SQL = ("SELECT SensorLocation, SensorMeasurement, round(CAST(SUM(SensorValue) AS DOUBLE) / COUNT(SensorValue), 6) "
           "AS AvgSensorValue, COUNT(Id) AS NumMeasurements, CAST(MAX(SensorValue) AS DOUBLE) AS HighestSensorValue, "
           "CAST(MIN(SensorValue) AS DOUBLE) AS LowestSensorValue FROM sensors GROUP BY 1, 2")


@register("agg_sensor_totals", Q.with_sensors(AGG_SQL))
def agg_sensor_totals(spark, sf_dir):
    """All-time statistics per (location, measurement)."""
    return agg.sensor_totals(_silver(spark, sf_dir))


_ROUTES_VALUES = ", ".join(f"('{n}', '{m}')" for n, m in S.DEFAULT_ROUTES.items())


@register("agg_by_route", Q.with_sensors(
    AGG_SQL.replace("SELECT SensorLocation", "SELECT r.route, SensorLocation")
           .replace("FROM sensors GROUP BY 1, 2",
                    f"FROM sensors JOIN (VALUES {_ROUTES_VALUES}) AS r(route, lit) ON SensorMeasurement = r.lit "
                    "GROUP BY 1, 2, 3")))
def agg_by_route(spark, sf_dir):
    """Statistics per configured route in one pass (rows tagged with their route,
    one grouping)."""
    tagged = clean.route_tagged(_silver(spark, sf_dir))
    return agg.sensor_totals(tagged, keys=("route", "SensorLocation", "SensorMeasurement"))


def _window_sql(size_min: int, slide_min: int | None) -> str:
    stats = ("round(CAST(SUM(SensorValue) AS DOUBLE) / COUNT(SensorValue), 6) AS AvgSensorValue, COUNT(Id) AS NumMeasurements, "
             "CAST(MAX(SensorValue) AS DOUBLE) AS HighestSensorValue, CAST(MIN(SensorValue) AS DOUBLE) AS LowestSensorValue")
    if slide_min:
        n = size_min // slide_min
        shifts = ", ".join(f"({i})" for i in range(n))
        src = (f"(SELECT s.*, time_bucket(INTERVAL {slide_min} MINUTE, MeasurementDateTime) - v.i * INTERVAL {slide_min} MINUTE "
               f"AS window_start FROM sensors s, (VALUES {shifts}) AS v(i))")
    else:
        src = f"(SELECT s.*, time_bucket(INTERVAL {size_min} MINUTE, MeasurementDateTime) AS window_start FROM sensors s)"
    return (f"SELECT SensorLocation, SensorMeasurement, window_start, window_start + INTERVAL {size_min} MINUTE AS window_end, "
            f"{stats} FROM {src} GROUP BY 1, 2, 3, 4")


@register("agg_sliding", Q.with_sensors(_window_sql(10, 5)))
def agg_sliding(spark, sf_dir):
    """10-minute windows sliding by 5 minutes per (location, measurement)."""
    return agg.window_stats(_silver(spark, sf_dir), "10 minutes", "5 minutes")


@register("agg_tumbling", Q.with_sensors(_window_sql(10, None)))
def agg_tumbling(spark, sf_dir):
    """Tumbling 10-minute windows."""
    return agg.window_stats(_silver(spark, sf_dir), "10 minutes", None)


SESSION_SQL = """SELECT SensorLocation, SensorMeasurement, MIN(MeasurementDateTime) AS session_start,
  MAX(MeasurementDateTime) + INTERVAL 30 MINUTE AS session_end,
  round(CAST(SUM(SensorValue) AS DOUBLE) / COUNT(SensorValue), 6) AS AvgSensorValue, COUNT(Id) AS NumMeasurements,
  CAST(MAX(SensorValue) AS DOUBLE) AS HighestSensorValue, CAST(MIN(SensorValue) AS DOUBLE) AS LowestSensorValue
FROM (SELECT *, SUM(CASE WHEN prev IS NULL OR MeasurementDateTime - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY SensorLocation, SensorMeasurement ORDER BY MeasurementDateTime, Id) AS sid
      FROM (SELECT *, lag(MeasurementDateTime) OVER (PARTITION BY SensorLocation, SensorMeasurement
                                                     ORDER BY MeasurementDateTime, Id) AS prev FROM sensors))
GROUP BY SensorLocation, SensorMeasurement, sid"""


@register("agg_session", Q.with_sensors(SESSION_SQL))
def agg_session(spark, sf_dir):
    """Activity sessions with a 30-minute gap."""
    return agg.session_stats(_silver(spark, sf_dir), "30 minutes")


@register("unique_sensors", Q.with_sensors("SELECT DISTINCT SensorMeasurement FROM sensors"))
def unique_sensors(spark, sf_dir):
    """Distinct sensors published as a global temp view and read back by name."""
    clean.unique_values(_silver(spark, sf_dir)).createOrReplaceGlobalTempView("unique_sensors")
    return spark.table("global_temp.unique_sensors")


# raw-export shape derived from events: no window start for error rows, no value below 5
def _raw(spark, sf_dir):
    s = fx.sensors(spark, sf_dir)
    return s.select(
        F.lit(None).cast("string").alias("Skip"), F.lit("_result").alias("SkipResult"), F.lit("0").alias("SkipTable"),
        F.when(F.col("SensorMeasurement") != S.WATER_DEPTH_FEET, F.date_trunc("day", "MeasurementDateTime"))
         .cast("timestamp").alias("WindowAverageStartDateTime"),
        F.date_trunc("day", "MeasurementDateTime").cast("timestamp").alias("WindowAverageStopDateTime"),
        F.col("MeasurementDateTime").cast("timestamp").alias("MeasurementDateTime"),
        F.when(F.col("SensorValue") >= 5, F.col("SensorValue")).alias("SensorValue"),
        "SensorUnitDescription", "SensorMeasurement", "SensorLocation", F.col("Id").cast("string").alias("Id"))


CLEAN_SQL = ("SELECT MeasurementDateTime, CAST(SensorValue AS DOUBLE) AS SensorValue, SensorUnitDescription, "
             "SensorMeasurement, SensorLocation, CAST(Id AS VARCHAR) AS Id FROM sensors "
             f"WHERE SensorMeasurement <> '{S.WATER_DEPTH_FEET}' AND SensorValue >= 5")


@register("clean_bronze", Q.with_sensors(CLEAN_SQL))
def clean_bronze(spark, sf_dir):
    """Drop rows without window start or value, drop the bookkeeping columns."""
    return clean.clean_raw(_raw(spark, sf_dir))


@register("json_quarantine", Q.with_sensors(
    "SELECT Id, CASE WHEN json_valid(p) THEN '' ELSE p END AS malformed FROM "
    "(SELECT Id, payload AS p FROM sensors UNION ALL SELECT -1 - Id AS Id, substr(payload, 2) AS p FROM sensors)"))
def json_quarantine(spark, sf_dir):
    """F8: payload text when malformed, '' when valid (strict RFC check); the second half
    of the rows are the payloads without their first character."""
    s = fx.sensors(spark, sf_dir, with_payload=True)
    both = s.select("Id", F.col("payload").alias("p")).unionByName(
        s.select((F.lit(-1) - F.col("Id")).alias("Id"), F.substring("payload", 2, 1 << 30).alias("p")))
    return both.select("Id", jc.malformed_json("p", strict=True).alias("malformed"))


_ID_COLS = ("SensorMeasurement", "SensorLocation", "MHour")


@register("deterministic_id", Q.with_sensors(
    "SELECT SensorMeasurement, SensorLocation, MHour, sha256(" + " || ".join(
        f"coalesce(len(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in (*_ID_COLS, "k")) + ") AS Id "
    "FROM (SELECT *, row_number() OVER (PARTITION BY SensorMeasurement, SensorLocation, MHour) - 1 AS k FROM (SELECT SensorMeasurement, SensorLocation, date_trunc('hour', MeasurementDateTime) AS MHour FROM sensors))"))
def deterministic_id(spark, sf_dir):
    """content hash + ordinal among exact duplicates (readings per sensor-hour)."""
    s = _silver(spark, sf_dir).select("SensorMeasurement", "SensorLocation",
                                      F.date_trunc("hour", "MeasurementDateTime").cast("timestamp_ntz").alias("MHour"))
    return ids.with_deterministic_id(s, list(_ID_COLS))


@register("verify_join", Q.with_sensors(
    "SELECT s.Id, s.SensorMeasurement, wq.Id AS VerifiedId FROM sensors s LEFT JOIN "
    f"(SELECT * FROM sensors WHERE SensorMeasurement = '{S.WATER_QUALITY}') wq "
    f"ON wq.MeasurementDateTime = s.MeasurementDateTime AND s.SensorMeasurement = '{S.WATER_QUALITY}'"))
def verify_join(spark, sf_dir):
    """Left equi-join on time with a literal predicate on the left side only."""
    s = _silver(spark, sf_dir)
    wq = fx.route(s, S.WATER_QUALITY).select(F.col("MeasurementDateTime").alias("_t"), F.col("Id").alias("VerifiedId"))
    j = s.join(wq, (F.col("MeasurementDateTime") == F.col("_t")) & (F.col("SensorMeasurement") == F.lit(S.WATER_QUALITY)),
               "left")
    return j.select("Id", "SensorMeasurement", "VerifiedId")


# --------------------------------------------------------------------------- merges / CDC
# the table ends at two thirds of the time span, the updates begin at one third
MERGE_CTES = (f"tgt AS (SELECT {Q.SILVER_COLS} FROM sensors WHERE MeasurementDateTime < {Q.cut_sql(2)}),\n"
              f"upd AS (SELECT Id, MeasurementDateTime, CAST(SensorValue AS DOUBLE) + 1 AS SensorValue, SensorUnitDescription, "
              f"SensorMeasurement, SensorLocation FROM sensors WHERE MeasurementDateTime >= {Q.cut_sql(1)})")


def _merge_inputs(spark, sf_dir):
    s = _silver(spark, sf_dir).withColumn("SensorValue", F.col("SensorValue").cast("double"))
    early, late = cut_times(s, "MeasurementDateTime")
    tgt = s.filter(F.col("MeasurementDateTime") < F.lit(late).cast("timestamp_ntz"))
    upd = (s.filter(F.col("MeasurementDateTime") >= F.lit(early).cast("timestamp_ntz"))
            .withColumn("SensorValue", F.col("SensorValue") + 1))
    return tgt, upd


@register("upsert_all", Q.with_sensors(
    "SELECT * FROM tgt WHERE Id NOT IN (SELECT Id FROM upd) UNION ALL SELECT * FROM upd", extra_ctes=MERGE_CTES))
def upsert_all(spark, sf_dir):
    """Update matched ids, insert the rest (late batch overlapping the table)."""
    tgt, upd = _merge_inputs(spark, sf_dir)
    return mg.upsert(tgt, upd, ["Id"])


@register("merge_insert_only", Q.with_sensors(
    "SELECT * FROM tgt UNION ALL SELECT * FROM upd WHERE Id NOT IN (SELECT Id FROM tgt)", extra_ctes=MERGE_CTES))
def merge_insert_only(spark, sf_dir):
    """Insert rows with new ids only; existing rows keep their values."""
    tgt, upd = _merge_inputs(spark, sf_dir)
    return mg.insert_only(tgt, upd, ["Id"])


@register("incremental_high_water", Q.with_sensors(
    "SELECT * FROM upd WHERE MeasurementDateTime > (SELECT MAX(MeasurementDateTime) FROM tgt)", extra_ctes=MERGE_CTES))
def incremental_high_water(spark, sf_dir):
    """Source rows newer than the newest target row, which the target's Parquet footers tell."""
    tgt, upd = _merge_inputs(spark, sf_dir)
    path = f"{scratch_dir(spark, 'high-water')}/t"
    mg.with_mark(tgt, "MeasurementDateTime").write.parquet(path)
    return mg.above_mark(upd, "MeasurementDateTime", mg.stored_high_water(spark, path))


# change feed: key (user_id, event_type), sequence ts, tiebreak event_id; values below 5
# arrive as NULL updates; error readings below 50 are deletes
CDC_FEED_SQL = ("feed AS (SELECT user_id, event_type, ts, event_id, CASE WHEN value < 5 THEN NULL ELSE value END AS value, "
                "props, (event_type = 'error' AND value < 50) AS is_delete, "
                "(event_type = 'signup' AND value >= 300) AS is_truncate FROM events)")
CDC_KEYS = ["user_id", "event_type"]


def _cdc_feed(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("user_id", "event_type", "ts", "event_id",
                     F.when(F.col("value") >= 5, F.col("value")).alias("value"), "props",
                     F.col("value").alias("raw_value"))


def _apply_in_batches(spark, sf_dir, **kw):
    """Apply the feed as two batches split by time, the later batch first (late data)."""
    feed = _cdc_feed(spark, sf_dir)
    cut = F.lit(cut_times(feed, "ts", 2)[0]).cast("timestamp_ntz")
    late, early = feed.filter(F.col("ts") >= cut), feed.filter(F.col("ts") < cut)
    common = dict(keys=CDC_KEYS, sequence_by="ts", tiebreak=["event_id"])
    common.update(kw)
    # the state between batches is a stored table, as in a pipeline (no growing lineage)
    state = materialize(mg.apply_changes(None, late, **common), "cdc-state")
    state = mg.apply_changes(state, early, **common)
    return mg.visible(state)


_DEL_COND = "event_type = 'error' AND raw_value < 50"
_TRUNC_COND = "event_type = 'signup' AND raw_value >= 300"
_LATEST = ("ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn "
           "FROM feed)")


@register("apply_changes_scd1", Q.with_sensors(
    "SELECT user_id, event_type, ts, value, props FROM ranked WHERE rn = 1 AND NOT is_delete",
    extra_ctes=CDC_FEED_SQL + ",\n" + _LATEST))
def apply_changes_scd1(spark, sf_dir):
    """Latest change per key wins (late older batch loses), deletes remove keys."""
    return _apply_in_batches(spark, sf_dir, apply_as_deletes=_DEL_COND,
                             except_column_list=["raw_value", "event_id"]).drop("event_id")


@register("apply_changes_ignore_nulls", Q.with_sensors(
    "SELECT user_id, event_type, MAX(ts) AS ts, arg_max(value, ts) FILTER (WHERE value IS NOT NULL) AS value, "
    "arg_max(props, ts) AS props FROM feed GROUP BY 1, 2",
    extra_ctes=CDC_FEED_SQL))
def apply_changes_ignore_nulls(spark, sf_dir):
    """NULL values in a change keep the previous value of that column."""
    return _apply_in_batches(spark, sf_dir, ignore_null_updates=True,
                             except_column_list=["raw_value", "event_id"]).drop("event_id")


@register("apply_changes_truncate", Q.with_sensors(
    "SELECT user_id, event_type, ts, value, props FROM ranked WHERE rn = 1 AND NOT is_delete "
    "AND (ts > (SELECT MAX(ts) FROM feed WHERE is_truncate) OR NOT EXISTS (SELECT 1 FROM feed WHERE is_truncate))",
    extra_ctes=CDC_FEED_SQL + ",\n" + _LATEST.replace("FROM feed)", "FROM feed WHERE NOT is_truncate)")))
def apply_changes_truncate(spark, sf_dir):
    """A truncate change empties the table as of its sequence."""
    return _apply_in_batches(spark, sf_dir, apply_as_deletes=_DEL_COND, apply_as_truncates=_TRUNC_COND,
                             except_column_list=["raw_value", "event_id"]).drop("event_id")


@register("apply_changes_columns", Q.with_sensors(
    "SELECT user_id, event_type, ts, value FROM ranked WHERE rn = 1", extra_ctes=CDC_FEED_SQL + ",\n" + _LATEST))
def apply_changes_columns(spark, sf_dir):
    """Only the listed columns are tracked (column_list)."""
    return _apply_in_batches(spark, sf_dir, column_list=["value"]).drop("event_id")


@register("latest_per_key", Q.with_sensors(
    "SELECT user_id, event_type, ts, event_id, value FROM ranked WHERE rn = 1",
    extra_ctes="feed AS (SELECT * FROM events),\n" + _LATEST))
def latest_per_key_q(spark, sf_dir):
    """Newest event per (user, type) by time, then id."""
    ev = fx.table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return latest_per_key(ev, CDC_KEYS, "ts", ["event_id"])


@register("scd2_history", Q.with_sensors(
    "SELECT user_id, event_type, event_id, value, ts AS __START_AT, nxt AS __END_AT, nxt IS NULL AS __IS_CURRENT "
    "FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nxt FROM feed) "
    "WHERE NOT is_delete", extra_ctes=CDC_FEED_SQL))
def scd2_history(spark, sf_dir):
    """Version history with validity intervals; deletes close the open version."""
    feed = _cdc_feed(spark, sf_dir)
    h = mg.scd2_history(feed, CDC_KEYS, "ts", ["event_id"], apply_as_deletes=_DEL_COND)
    return h.select("user_id", "event_type", "event_id", "value", "__START_AT", "__END_AT", "__IS_CURRENT")


SCD2_SQL = ORACLES["scd2_history"]


@register("scd2_history_positions", SCD2_SQL)
def scd2_history_positions(spark, sf_dir):
    """J11 with a key's changes cut into several range partitions."""
    feed = _cdc_feed(spark, sf_dir)
    h = mg.scd2_history(feed, CDC_KEYS, "ts", ["event_id"], apply_as_deletes=_DEL_COND, num_partitions=7)
    return h.select("user_id", "event_type", "event_id", "value", "__START_AT", "__END_AT", "__IS_CURRENT")


# --------------------------------------------------------------------------- expectations
EXPECT_CTE = ("ex AS (SELECT Id, CASE WHEN SensorMeasurement = 'h2o_feet' AND SensorValue > 400 THEN NULL "
              "ELSE MeasurementDateTime END AS MeasurementDateTime, CAST(CASE WHEN SensorValue >= 5 THEN SensorValue END AS DOUBLE) AS SensorValue, "
              "CASE WHEN user_id >= 10 THEN SensorLocation END AS SensorLocation, SensorMeasurement FROM sensors)")
RULES = {"MeasurementDateTime": "MeasurementDateTime IS NOT NULL", "SensorValue": "SensorValue IS NOT NULL",
         "SensorLocation": "SensorLocation IS NOT NULL"}
SQL_RULES = {"time_is_valid": "TRY_CAST(MeasurementDateTime AS TIMESTAMP) IS NOT NULL",
             "value_above_one": "SensorValue > 1"}


def _expect_input(spark, sf_dir):
    s = fx.sensors(spark, sf_dir, with_user=True)
    return s.select(
        "Id",
        F.when((F.col("SensorMeasurement") == S.WATER_DEPTH_FEET) & (F.col("SensorValue") > 400), F.lit(None))
         .otherwise(F.col("MeasurementDateTime")).alias("MeasurementDateTime"),
        F.when(F.col("SensorValue") >= 5, F.col("SensorValue")).alias("SensorValue"),
        F.when(F.col("user_id") >= 10, F.col("SensorLocation")).alias("SensorLocation"),
        "SensorMeasurement")


def _rules_sql(rules) -> str:
    return " AND ".join(f"COALESCE({p}, FALSE)" for p in rules.values())


@register("expect_drop", Q.with_sensors(f"SELECT * FROM ex WHERE {_rules_sql(RULES)}", extra_ctes=EXPECT_CTE))
def expect_drop(spark, sf_dir):
    """Q1/Q5: drop rows failing any named rule."""
    return qual.expect_or_drop(_expect_input(spark, sf_dir), RULES)


@register("expect_drop_sql", Q.with_sensors(f"SELECT * FROM ex WHERE {_rules_sql(SQL_RULES)}", extra_ctes=EXPECT_CTE))
def expect_drop_sql(spark, sf_dir):
    """Q4: SQL constraints (time castable, value > 1), violating rows dropped."""
    return qual.expect_or_drop(_expect_input(spark, sf_dir), SQL_RULES)


@register("expect_quarantine", Q.with_sensors(
    "SELECT * FROM (SELECT *, concat_ws(',', " + ", ".join(
        f"CASE WHEN NOT COALESCE({p}, FALSE) THEN '{n}' END" for n, p in RULES.items())
    + ") AS failed_rules FROM ex) WHERE failed_rules <> ''", extra_ctes=EXPECT_CTE))
def expect_quarantine(spark, sf_dir):
    """Q6: rejected rows with the names of the rules they failed."""
    q = qual.quarantine(_expect_input(spark, sf_dir), RULES)
    return q.withColumn("failed_rules", F.array_join("failed_rules", ","))


@register("expect_metrics", Q.with_sensors(
    "SELECT COUNT(*) AS rows, " + ", ".join(
        f"CAST(SUM(CASE WHEN NOT COALESCE({p}, FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS failed_{n}" for n, p in RULES.items())
    + f", CAST(SUM(CASE WHEN NOT ({_rules_sql(RULES)}) THEN 1 ELSE 0 END) AS BIGINT) AS dropped FROM ex",
    extra_ctes=EXPECT_CTE))
def expect_metrics(spark, sf_dir):
    """Q3: keep all rows, report failures per rule."""
    return qual.expectation_counts(_expect_input(spark, sf_dir), RULES)


# --------------------------------------------------------------------------- forecast extras
@register("series_mean", Q.with_sensors(
    "SELECT date_trunc('hour', MeasurementDateTime) AS ds, SensorMeasurement, SensorLocation, "
    "round(CAST(SUM(SensorValue) AS DOUBLE) / COUNT(SensorValue), 6) AS y, "
    "SensorMeasurement || '-' || SensorLocation AS ts_id FROM sensors GROUP BY 1, 2, 3"))
def series_mean(spark, sf_dir):
    """Mean per (hour, id columns) with the joined ts_id."""
    s = fc.hourly_series(_silver(spark, sf_dir), id_cols=("SensorMeasurement", "SensorLocation"))
    return s.withColumn("y", F.round("y", 6))


@register("series_span", Q.with_sensors(
    "SELECT SensorMeasurement AS ts_id, MIN(date_trunc('hour', MeasurementDateTime)) AS start_time, "
    "MAX(date_trunc('hour', MeasurementDateTime)) AS end_time, COUNT(DISTINCT date_trunc('hour', MeasurementDateTime)) AS n_obs "
    "FROM sensors GROUP BY 1"))
def series_span(spark, sf_dir):
    """Start and end of each series."""
    return fc.series_span(fc.hourly_series(_silver(spark, sf_dir)))


@register("forecast_mean_metrics", Q.with_sensors(
    "SELECT " + ", ".join(f"round(AVG({m}), 6) AS val_{m}" for m in fc.METRICS) + " FROM ("
    + Q.METRICS_SELECT.replace("round(", "(").replace(", 6) AS", ") AS") + ")",
    extra_ctes=Q.metrics_sql().rstrip()))
def forecast_mean_metrics(spark, sf_dir):
    """Mean of the seven metrics over all series (val_ prefix)."""
    m = fc.mean_metrics(fc.evaluate(fc.hourly_series(_silver(spark, sf_dir))))
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@register("series_without_model", Q.with_sensors(
    "SELECT DISTINCT ts_id FROM named WHERE ts_id NOT IN (SELECT ts_id FROM named WHERE MeasurementDateTime < " + Q.cut_sql(1, 10) + " AND SensorValue IS NOT NULL)",
    extra_ctes="named AS (SELECT *, SensorMeasurement || '-' || CAST(user_id AS VARCHAR) AS ts_id FROM sensors)"))
def series_without_model(spark, sf_dir):
    """Per-(sensor, user) series that the stored models don't cover: the models were fitted on the first tenth of the time
    span, and a fit without values has failed."""
    from ..streaming import serving
    s = fx.sensors(spark, sf_dir, with_user=True)
    past = s.filter(F.col("MeasurementDateTime") < F.lit(cut_times(s, "MeasurementDateTime", 10)[0]).cast("timestamp_ntz"))
    path = f"{scratch_dir(spark, 'models')}/m"
    serving.store_models(serving.model_rows(fc.hourly_series(past, id_cols=("SensorMeasurement", "user_id"))), path)
    fitted = serving.newest_models(spark, path).filter(F.get_json_object("model_json", "$.intercept").isNotNull())
    return fc.series_without_model(fc.hourly_series(s, id_cols=("SensorMeasurement", "user_id")), fitted)


from . import stream_queries  # noqa: E402,F401  (registers the streaming queries)
from . import recovery_queries  # noqa: E402,F401  (registers streams that fail, restart, run side by side, serve a model)


# --------------------------------------------------------------------------- searched forecast
def _ridge_models(spark, sf_dir):
    from ..operators import ridge
    return ridge.best_models(spark, fc.hourly_series(_silver(spark, sf_dir)))


@register("forecast_best_model")
def forecast_best_model(spark, sf_dir):
    """Per sensor, 10 trials x 5 rolling folds of the penalised model,
    best trial by smape (FORECAST_RESULT rows).  No SQL oracle (iterative solver);
    tests compare the distributed fit with a direct numpy fit."""
    return _ridge_models(spark, sf_dir)


@register("forecast_ridge_predict")
def forecast_ridge_predict(spark, sf_dir):
    """24 future hours per sensor from the stored model_json."""
    from ..operators import ridge
    return ridge.predict_future(materialize(_ridge_models(spark, sf_dir), "ridge-models"))   # read twice: steps and their start


from . import table_queries  # noqa: E402,F401  (registers table, layout, audit and pipeline queries)


@register("gold_daily_verified", Q.gold_daily_verified_sql(gold.VERIFIED_COLUMNS))
def gold_daily_verified(spark, sf_dir):
    """A4 without join fan-out: true readings per day and their mean, with the same
    verified-id counts (hour-truncated times, where the fan-out would occur)."""
    return _gold_daily(spark, sf_dir, hourly=True, keep_fanout=False, with_forecast=False)


@register("ma_short_long", Q.with_sensors(Q.ma_select(gold.AIR_FRAMES, where=f"SensorMeasurement = '{S.AIR_TEMP}'")))
def ma_short_long(spark, sf_dir):
    """L3/W1/W2 through the SQL API: a view over the distributed moving averages, read by SQL."""
    gold.ma_table(_silver(spark, sf_dir), S.AIR_TEMP, gold.AIR_FRAMES).createOrReplaceTempView("air_temp_smoothed")
    return spark.sql("SELECT * FROM air_temp_smoothed")


# --------------------------------------------------------------------------- stored tables
_STORED_KEYS = ["user_id", "event_type"]


def _stored(spark, name: str, **kw) -> stored.BucketedTable:
    return stored.BucketedTable(spark, f"{scratch_dir(spark, name)}/table", _STORED_KEYS, n_buckets=4, **kw)


def _events(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")


_LATEST = ("SELECT user_id, event_type, ts, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
           "ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")


@register("stored_first_load_duplicates", _LATEST)
def stored_first_load_duplicates(spark, sf_dir):
    """J3 on a stored table: the first load holds many rows per key, of which the latest stays."""
    table = _stored(spark, "first-load", partition_by=["event_type"])
    table.upsert(_events(spark, sf_dir), sequence_by="ts", tiebreak=["event_id"])
    return table.read().select("user_id", "event_type", "ts", "event_id", "value")


@register("stored_late_update", _LATEST)
def stored_late_update(spark, sf_dir):
    """J3 on a stored table: the older half arrives after the newer one and changes nothing that is newer."""
    ev = _events(spark, sf_dir)
    middle = ev.agg(F.timestamp_seconds(F.avg(F.unix_seconds(F.col("ts").cast("timestamp")))).cast("timestamp_ntz")).first()[0]
    table = _stored(spark, "late-update")
    for part in (ev.filter(F.col("ts") >= F.lit(middle)), ev.filter(F.col("ts") < F.lit(middle)), ev.filter(F.col("ts") < F.lit(middle))):
        table.upsert(part, sequence_by="ts", tiebreak=["event_id"])
    return table.read().select("user_id", "event_type", "ts", "event_id", "value")


@register("stored_truncate", "WITH t AS (SELECT max(ts) AS cut FROM events WHERE event_type = 'error'), late AS "
          "(SELECT * FROM events, t WHERE ts > cut AND event_type <> 'error') "
          + _LATEST.replace("FROM events", "FROM late"))
def stored_truncate(spark, sf_dir):
    """J9 on a stored table: the last truncate (an error event) empties what is older, in every bucket."""
    table = _stored(spark, "truncate")
    ev = _events(spark, sf_dir)
    kw = dict(sequence_by=["ts", "event_id"], apply_as_truncates="event_type = 'error'")
    table.apply_changes(ev.filter("event_type <> 'error'"), **kw)
    table.apply_changes(ev.filter("event_type = 'error'"), **kw)
    return table.read().select("user_id", "event_type", "ts", "event_id", "value")


@register("stored_scd2_late", ORACLES["scd2_history"])
def stored_scd2_late(spark, sf_dir):
    """J11 on a stored table: the feed arrives in three batches, the middle of it last and part of it twice; late changes cut the
    intervals that are already stored."""
    feed = _cdc_feed(spark, sf_dir)
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    table = stored.Scd2Table(spark, f"{scratch_dir(spark, 'scd2')}/table", CDC_KEYS, n_buckets=4)
    for part in (feed.filter(third == 0), feed.filter(third == 2), feed.filter(third >= 1)):
        table.apply(part, "ts", ["event_id"], apply_as_deletes=_DEL_COND)
    return table.read().select("user_id", "event_type", "event_id", "value", "__START_AT", "__END_AT", "__IS_CURRENT")


@register("id_no_collision", "SELECT count(*) AS num_rows, count(*) AS num_ids FROM (SELECT DISTINCT event_type, user_id, event_id FROM events)")
def id_no_collision(spark, sf_dir):
    """contents that differ only in where a separator stands get different ids."""
    ev = fx.table(spark, sf_dir, "events").select("event_type", F.col("user_id").cast("string").alias("u"), F.col("event_id").cast("string").alias("e")).distinct()
    a = ev.select(F.concat_ws("|", "event_type", "u").alias("a"), F.col("e").alias("b"))
    b = ev.select(F.col("event_type").alias("a"), F.concat_ws("|", "u", "e").alias("b"))
    both = ids.with_deterministic_id(a.unionByName(b), ["a", "b"])
    return both.agg((F.count("*") / 2).cast("long").alias("num_rows"), (F.count_distinct("Id") / 2).cast("long").alias("num_ids"))


@register("bronze_rename", Q.with_sensors(
    "SELECT date_trunc('day', MeasurementDateTime) AS MeasurementWindowStartTime, date_trunc('day', MeasurementDateTime) AS "
    "MeasurementWindowEndTime, MeasurementDateTime, CAST(SensorValue AS DOUBLE) AS SensorValue, SensorUnitDescription, "
    "SensorMeasurement, SensorLocation, Id FROM sensors UNION ALL SELECT date_trunc('day', MeasurementDateTime), "
    "date_trunc('day', MeasurementDateTime), NULL, CAST(SensorValue AS DOUBLE), SensorUnitDescription, SensorMeasurement, "
    f"SensorLocation, -1 - Id FROM sensors WHERE SensorMeasurement = '{S.AIR_TEMP}'"))
def bronze_rename(spark, sf_dir):
    """Renamed window columns and a tolerant time cast; malformed times become NULL."""
    day = F.date_trunc("day", "MeasurementDateTime").cast("timestamp_ntz")
    s = _silver(spark, sf_dir).withColumns({"WindowAverageStartDateTime": day, "WindowAverageStopDateTime": day})
    text = s.withColumn("MeasurementDateTime", F.col("MeasurementDateTime").cast("string"))
    bad = fx.route(text, S.AIR_TEMP).withColumns({"MeasurementDateTime": F.lit("MeasurementDateTime"), "Id": F.lit(-1) - F.col("Id")})
    out = clean.bronze_rename(text.unionByName(bad))
    return out.withColumn("MeasurementDateTime", F.col("MeasurementDateTime").cast("timestamp_ntz"))


@register("semi_join", Q.with_sensors(
    f"SELECT {Q.SILVER_COLS} FROM sensors s WHERE EXISTS (SELECT 1 FROM sensors a WHERE a.SensorMeasurement = '{S.AIR_TEMP}' "
    "AND a.SensorLocation = s.SensorLocation AND a.SensorValue > 10)"))
def semi_join(spark, sf_dir):
    """Readings at places where the air was warm at some time, each once."""
    s = _silver(spark, sf_dir)
    warm = fx.route(s, S.AIR_TEMP).filter(F.col("SensorValue") > 10)
    return s.join(warm.select("SensorLocation"), "SensorLocation", "left_semi").select(*s.columns)


@register("idempotent_batches", Q.with_sensors(f"SELECT {Q.SILVER_COLS}, CAST(SensorMeasurement = '{S.AIR_TEMP}' AS BIGINT) AS _batch_id FROM sensors"))
def idempotent_batches(spark, sf_dir):
    """K9: two batches appended, the first of them three times."""
    from ..sources import sinks
    path = f"{scratch_dir(spark, 'idempotent')}/t"
    s = _silver(spark, sf_dir)
    for batch_id in (0, 1, 0, 0):
        sinks.append_batch(s.filter((F.col("SensorMeasurement") == S.AIR_TEMP) == F.lit(bool(batch_id))), path, batch_id)
    return spark.read.parquet(path).withColumn("_batch_id", F.col("_batch_id").cast("long"))


@register("forecast_future_frame", Q.with_sensors("SELECT ts_id, ds FROM future", extra_ctes=Q.forecast_future_sql().rstrip()))
def forecast_future_frame(spark, sf_dir):
    """The next 24 hours of every series, from the latest end of all."""
    series = materialize(fc.hourly_series(_silver(spark, sf_dir)), "hourly-series")
    return fc.future_frame(fc.series_span(series)).withColumn("ds", F.col("ds").cast("timestamp_ntz"))


@register("ordered_result", Q.with_sensors(f"SELECT {Q.SILVER_COLS} FROM sensors ORDER BY MeasurementDateTime DESC, Id"))
def ordered_result(spark, sf_dir):
    """A full result in order (a range shuffle, no single task)."""
    return _silver(spark, sf_dir).orderBy(F.col("MeasurementDateTime").desc(), "Id")
