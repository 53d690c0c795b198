"""Baseline, validation and read-side queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import anomaly, baseline, readmodels
from ..session import release, scratch_path
from ..sinks.tables import staged_write, write_parquet
from ..sources import fixtures as fx
from ..streaming import new_rows
from . import oracle as o
from .catalog import register
from .joins import kept_lookup

# --------------------------------------------------------------------------
# shared SQL pieces

ANOMALIES_CTE = """
dev_stats AS (
  SELECT device_id, avg(active_power) AS mean, stddev_samp(active_power) AS stddev
  FROM readings GROUP BY device_id HAVING count(active_power) >= 3
),
anomalies AS (
  SELECT r.*, (r.active_power < s.mean - 3 * s.stddev OR r.active_power > s.mean + 3 * s.stddev)
         AS is_anomaly
  FROM readings r JOIN dev_stats s USING (device_id)
  WHERE (r.active_power < s.mean - 3 * s.stddev OR r.active_power > s.mean + 3 * s.stddev)
        OR r.is_injected_anomaly
)"""

EXPECTED_CTE = """
hours AS (
  SELECT hour_of_day AS _hour, avg(active_power) AS _base,
         avg(CASE WHEN day_of_week BETWEEN 2 AND 6 THEN active_power END) AS wd,
         avg(CASE WHEN day_of_week IN (1, 7) THEN active_power END) AS we
  FROM cal WHERE hour_of_day IS NOT NULL GROUP BY hour_of_day
),
ratios AS (
  SELECT _hour, _base,
         CASE WHEN we IS NOT NULL AND we <> 0 AND wd IS NOT NULL AND wd <> 0 AND wd > 0
              THEN we / wd ELSE 1.3 END AS _ratio
  FROM hours
),
tot AS (
  SELECT avg(active_power) AS a,
         avg(CASE WHEN "month" IN (12, 1, 2) THEN active_power END) AS w,
         avg(CASE WHEN "month" IN (6, 7, 8) THEN active_power END) AS s,
         avg(CASE WHEN "month" IN (3, 4, 5, 9, 10, 11) THEN active_power END) AS o
  FROM cal
),
sf AS (
  SELECT CASE WHEN ok THEN w / a ELSE 1.3 END AS f_w, CASE WHEN ok THEN s / a ELSE 1.2 END AS f_s,
         CASE WHEN ok THEN o / a ELSE 1.0 END AS f_o
  FROM (SELECT *, (w IS NOT NULL AND w <> 0 AND s IS NOT NULL AND s <> 0 AND o IS NOT NULL
                   AND o <> 0 AND a IS NOT NULL AND a > 0) AS ok FROM tot) t
),
expected AS (
  SELECT c.*, coalesce(r._base, 2.0) AS base_power,
         CASE WHEN c.day_of_week IN (1, 7) THEN coalesce(r._ratio, 1.3) ELSE 1.0 END AS weekend_factor,
         CASE WHEN c."month" IN (12, 1, 2) THEN f_w WHEN c."month" IN (6, 7, 8) THEN f_s
              ELSE f_o END AS seasonal_factor
  FROM cal c LEFT JOIN ratios r ON c.hour_of_day = r._hour CROSS JOIN sf
),
forecasts AS (
  SELECT event_id, "timestamp", active_power,
         base_power * weekend_factor * seasonal_factor AS prediction
  FROM expected
)"""


def _anomalies(spark, sf_dir):
    return anomaly.detect(fx.readings(spark, sf_dir))


def _forecasts(spark, sf_dir):
    """Baseline forecast table: expected power per reading."""
    e = baseline.expected_power(fx.readings(spark, sf_dir))
    return e.select("event_id", "timestamp", "active_power",
                    F.col("expected_power").alias("prediction"))


# --------------------------------------------------------------------------
# baseline

@register("expected_power", o.with_ctes(o.READINGS, o.CAL, EXPECTED_CTE) + """
SELECT event_id, device_id, "timestamp", active_power, hour_of_day, day_of_week, "month",
       round(base_power, 6) AS base_power, round(weekend_factor, 6) AS weekend_factor,
       round(seasonal_factor, 6) AS seasonal_factor,
       round(base_power * weekend_factor * seasonal_factor, 6) AS expected_power
FROM expected
""")
def expected_power(spark, sf_dir):
    """Calibrated expected load (hourly avg x weekend x seasonal factor)."""
    e = baseline.expected_power(fx.readings(spark, sf_dir))
    return e.select("event_id", "device_id", "timestamp", "active_power", "hour_of_day",
                    "day_of_week", "month",
                    *[r6(c).alias(c) for c in ("base_power", "weekend_factor",
                                               "seasonal_factor", "expected_power")])


_LI_CAL = """
cal AS (
  SELECT "timestamp", active_power, CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
         CAST(isodow("timestamp") % 7 + 1 AS INTEGER) AS day_of_week,
         CAST(month("timestamp") AS INTEGER) AS "month"
  FROM li_readings)"""


@register("expected_power_seasons", o.with_ctes(o.LINEITEM_READINGS, _LI_CAL, EXPECTED_CTE.replace(
    "SELECT event_id, ", "SELECT ")) + """
SELECT "month", count(*) AS n, round(min(seasonal_factor), 6) AS min_factor,
       round(max(seasonal_factor), 6) AS max_factor, round(min(weekend_factor), 6) AS min_weekend,
       round(max(weekend_factor), 6) AS max_weekend, round(avg(prediction), 3) AS avg_prediction
FROM (SELECT *, base_power * weekend_factor * seasonal_factor AS prediction FROM expected) e
GROUP BY "month"
""")
def expected_power_seasons(spark, sf_dir):
    """Expected load over several years: the seasonal factors come from the
    data, not from the defaults."""
    e = baseline.expected_power(fx.lineitem_readings(spark, sf_dir))
    return e.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), r6(F.min("seasonal_factor")).alias("min_factor"),
        r6(F.max("seasonal_factor")).alias("max_factor"), r6(F.min("weekend_factor")).alias("min_weekend"),
        r6(F.max("weekend_factor")).alias("max_weekend"),
        F.round(F.avg("expected_power"), 3).alias("avg_prediction"))


@register("device_class", o.with_ctes(o.READINGS) + """
SELECT device_id, device_num,
       CASE WHEN device_num < 20 THEN 'large' WHEN device_num > 80 THEN 'small'
            WHEN device_num IS NOT NULL THEN 'average' END AS device_class,
       n_readings
FROM (SELECT device_id, TRY_CAST(string_split(device_id, '_')[-1] AS INTEGER) AS device_num,
             count(*) AS n_readings
      FROM readings GROUP BY device_id) d
""")
def device_class(spark, sf_dir):
    """Consumer class per meter (large / average / small by meter number)."""
    from ..functions.columns import device_number
    per_device = fx.readings(spark, sf_dir).groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n_readings"))
    return per_device.select("device_id", device_number("device_id").alias("device_num"),
                             baseline.device_class("device_id").alias("device_class"),
                             "n_readings")


@register("clamped_readings", o.with_ctes(o.READINGS) + """
SELECT event_id, active_power_clamped, voltage_clamped,
       floor(CASE WHEN voltage_clamped > 0 THEN active_power_clamped / voltage_clamped ELSE 0.0 END
             * 1000.0 + 0.5) / 1000.0 AS current_derived
FROM (
  SELECT event_id, greatest(active_power, 0.01) AS active_power_clamped,
         CASE WHEN coalesce(is_injected_anomaly, false) THEN least(greatest(voltage, 180), 260)
              ELSE least(greatest(voltage, 215), 245) END AS voltage_clamped
  FROM readings
) c
""")
def clamped_readings(spark, sf_dir):
    """Physical clamps and derived current."""
    c = baseline.clamped(fx.readings(spark, sf_dir))
    return c.select("event_id", "active_power_clamped", "voltage_clamped", "current_derived")


# --------------------------------------------------------------------------
# validation

# Written out on purpose: the rules under test are a table in the library, so
# the oracle must not be made from it.
_VALIDATE_SQL = o.with_ctes(o.READINGS, o.REQUESTS, """
checked AS (
  SELECT event_id, [x FOR x IN [
    CASE WHEN Voltage < 0 OR Voltage > 500 THEN 'Voltage should be between 0 and 500V' END,
    CASE WHEN "current" < 0 OR "current" > 100 THEN 'Current should be between 0 and 100A' END,
    CASE WHEN Sub_metering_1 < 0 THEN 'Sub_metering_1 should be a positive value' END,
    CASE WHEN Sub_metering_2 < 0 THEN 'Sub_metering_2 should be a positive value' END,
    CASE WHEN Sub_metering_3 < 0 THEN 'Sub_metering_3 should be a positive value' END,
    CASE WHEN "hour" < 0 OR "hour" > 23 THEN 'Hour should be between 0 and 23' END,
    CASE WHEN day_of_week < 1 OR day_of_week > 7 THEN 'Day of week should be between 1 and 7' END,
    CASE WHEN "month" < 1 OR "month" > 12 THEN 'Month should be between 1 and 12' END
  ] IF x IS NOT NULL] AS errors FROM requests)""") + """
SELECT event_id, CAST(len(errors) AS INTEGER) AS n_errors,
       CASE WHEN len(errors) > 0 THEN array_to_string(errors, ', ') END AS error_message,
       len(errors) = 0 AS is_valid
FROM checked
"""


@register("validate_requests", _VALIDATE_SQL)
def validate_requests(spark, sf_dir):
    """Range/type validation of scoring requests with error messages."""
    v = readmodels.validate(fx.requests(spark, sf_dir))
    return v.select("event_id", "n_errors", "error_message", "is_valid")


# --------------------------------------------------------------------------
# read models

_FEED_SQL = ('"timestamp", active_power AS value, \'anomaly\' AS "type", device_id, '
             'is_anomaly, is_injected_anomaly, event_id')


@register("recent_anomalies", o.with_ctes(o.READINGS, ANOMALIES_CTE) + f"""
SELECT {_FEED_SQL} FROM anomalies ORDER BY "timestamp" DESC, event_id DESC LIMIT 100
""")
def recent_anomalies(spark, sf_dir):
    """The 100 newest anomalies, tagged 'anomaly' (top-k)."""
    return readmodels.newest(readmodels.anomaly_feed(_anomalies(spark, sf_dir)), 100)


@register("anomaly_history", o.with_ctes(o.READINGS, ANOMALIES_CTE) + f"""
SELECT {_FEED_SQL} FROM anomalies ORDER BY "timestamp" DESC, event_id DESC
""")
def anomaly_history(spark, sf_dir):
    """Full anomaly history, newest first (distributed sort, no limit)."""
    return readmodels.newest(readmodels.anomaly_feed(_anomalies(spark, sf_dir)), None)


@register("recent_list", o.with_ctes(o.READINGS, ANOMALIES_CTE) + """
SELECT device_id, active_power AS value, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS formatted_time,
       event_id
FROM anomalies ORDER BY "timestamp" DESC, event_id DESC LIMIT 50
""")
def recent_list(spark, sf_dir):
    """The 50-row alert list with display time text."""
    a = readmodels.newest(_anomalies(spark, sf_dir), 50)
    return a.select("device_id", F.col("active_power").alias("value"),
                    readmodels.formatted_time("timestamp").alias("formatted_time"), "event_id")


@register("recent_forecasts", o.with_ctes(o.READINGS, o.CAL, EXPECTED_CTE) + """
SELECT "timestamp", round(prediction, 6) AS value, 'forecast' AS "type", active_power, event_id
FROM forecasts ORDER BY "timestamp" DESC, event_id DESC LIMIT 100
""")
def recent_forecasts(spark, sf_dir):
    """The 100 newest forecasts, tagged 'forecast' (top-k)."""
    f = readmodels.newest(readmodels.forecast_feed(_forecasts(spark, sf_dir)), 100)
    return f.withColumn("value", r6("value"))


@register("series_overlay", o.with_ctes(o.READINGS, o.CAL, EXPECTED_CTE, ANOMALIES_CTE, """
f100 AS (SELECT * FROM forecasts ORDER BY "timestamp" DESC, event_id DESC LIMIT 100),
a100 AS (SELECT * FROM anomalies ORDER BY "timestamp" DESC, event_id DESC LIMIT 100)""") + """
SELECT "timestamp", round(prediction, 6) AS value, 'forecast' AS series FROM f100
UNION ALL SELECT "timestamp", round(active_power, 6) AS value, 'actual' AS series FROM f100
UNION ALL SELECT "timestamp", round(active_power, 6) AS value, 'anomaly' AS series FROM a100
""")
def series_overlay(spark, sf_dir):
    """Forecast, actual and anomaly series of the two 100-row feeds in one
    long table (timestamp, value, series)."""
    f = readmodels.newest(_forecasts(spark, sf_dir), 100)
    a = readmodels.newest(_anomalies(spark, sf_dir), 100)
    s = readmodels.series_overlay(f, a)
    return s.withColumn("value", r6("value"))


_NEW_SQL = o.with_ctes(o.READINGS, ANOMALIES_CTE, """
day_stats AS (
  SELECT device_id, strftime("timestamp", '%Y-%m-%d') AS day, avg(active_power) AS mean,
         stddev_samp(active_power) AS stddev
  FROM readings GROUP BY 1, 2 HAVING count(active_power) >= 3
),
known AS (
  SELECT r.device_id, r."timestamp" FROM readings r
  JOIN day_stats s ON r.device_id = s.device_id AND strftime(r."timestamp", '%Y-%m-%d') = s.day
  WHERE (r.active_power < s.mean - 3 * s.stddev OR r.active_power > s.mean + 3 * s.stddev)
        OR r.is_injected_anomaly
)""") + f"""
SELECT {_FEED_SQL} FROM anomalies a
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.device_id = a.device_id
                  AND k."timestamp" = a."timestamp")
"""


@register("new_anomalies", _NEW_SQL)
def new_anomalies(spark, sf_dir):
    """Anomalies of the per-device model not already reported by the
    per-day model (left anti join on device and timestamp)."""
    r = fx.readings(spark, sf_dir)
    known = anomaly.detect(r.withColumn("day", F.date_format("timestamp", "yyyy-MM-dd")),
                           keys=("device_id", "day"))
    incoming = readmodels.anomaly_feed(anomaly.detect(r))
    return readmodels.new_since(incoming, known)


@register("recent_from_table", o.with_ctes(o.READINGS, ANOMALIES_CTE) + f"""
SELECT {_FEED_SQL} FROM anomalies ORDER BY "timestamp" DESC, event_id DESC LIMIT 100
""")
def recent_from_table(spark, sf_dir):
    """The 100 newest anomalies of the written anomalies table, of which only the newest
    days are read."""
    path = scratch_path(spark, "anomalies-by-day")
    readmodels.write_by_day(readmodels.anomaly_feed(_anomalies(spark, sf_dir)), path)
    return readmodels.newest_by_day(spark.read.parquet(path), 100).drop("day")


@register("staged_table", o.with_ctes(o.READINGS) + """
SELECT event_id, active_power FROM readings
""")
def staged_table(spark, sf_dir):
    """A table that was written, then overwritten by a job that failed half way: it still
    holds the rows of the first write."""
    path = scratch_path(spark, "staged")
    rows = fx.readings(spark, sf_dir).select("event_id", "active_power")
    staged_write(rows, path)
    broken = rows.withColumn("active_power", F.when(F.col("event_id") % 100 != 99, F.lit(0.0)).otherwise(
        F.raise_error(F.lit("storage failed")).cast("double")))
    try:
        staged_write(broken, path)
    except Exception as e:  # noqa: BLE001 - the failure is the point
        if "storage failed" not in str(e):
            raise
    else:
        raise AssertionError("the second write should have failed")
    return spark.read.parquet(path)


# Micro-batches of a run at most: each reads the known rows again and has a fixed cost
# (every stateful task reports to the driver), so their number must not grow with the files.
_STREAM_BATCHES = 4


@register("stream_new_anomalies", _NEW_SQL)
def stream_new_anomalies(spark, sf_dir):
    """The same by a stream: anomalies arrive in blocks of days, each block a second time
    with the next one, and the query is stopped and restarted half way."""
    r = fx.readings(spark, sf_dir)
    known = kept_lookup(anomaly.detect(r.withColumn("day", F.date_format("timestamp", "yyyy-MM-dd")),
                                       keys=("device_id", "day")).select("device_id", "timestamp"), "known")
    feed = kept_lookup(readmodels.anomaly_feed(anomaly.detect(r)), "feed")
    src, sink, ckpt = (scratch_path(spark, n) for n in ("feed-blocks", "new-anomalies", "ckpt"))
    block = F.floor(F.dayofmonth("timestamp") / 8)
    for i in range(5):          # days 1 to 31; a block comes with the one before it
        feed.filter((block == i) | (block == i - 1)).write.parquet(f"{src}/block={i}")
        if i in (2, 4):
            files = len(spark.read.schema(feed.schema).option("recursiveFileLookup", "true").parquet(src).inputFiles())
            stream = (spark.readStream.schema(feed.schema)
                      .option("maxFilesPerTrigger", max(2, -(-files // _STREAM_BATCHES)))
                      .option("recursiveFileLookup", "true").parquet(src))
            new_rows.report_new(stream, sink, ckpt, known, delay="40 days", available_now=True).awaitTermination()
    release(spark, src, ckpt)
    return spark.read.schema(feed.schema).parquet(sink)


# A model registry derived from the readings: one model a device and day, trained in each
# half of the day that has readings (so ids repeat), with an info row for each training of
# two readings or more, saved to one or two locations.
_REGISTRY = (o.READINGS, """
parts AS (
  SELECT device_id, device_id || '_' || strftime("timestamp", '%Y%m%d') AS model_timestamp,
         hour("timestamp") >= 12 AS late, count(*) AS n, min("timestamp") AS first_at,
         max("timestamp") AS last_at, round(stddev_samp(active_power), 6) AS rmse,
         round(avg(active_power), 6) AS r2
  FROM readings GROUP BY 1, 2, 3)""", """
runs AS (
  SELECT device_id, model_timestamp, CASE WHEN n < 2 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CAST(n AS DOUBLE) AS duration_seconds, CASE WHEN n < 2 THEN 'too few readings' END AS error_message,
         first_at AS started_at
  FROM parts)""", """
info AS (SELECT device_id, model_timestamp, rmse, r2, last_at AS created_at FROM parts WHERE n >= 2)""", """
artifacts AS (
  SELECT device_id AS kind, model_timestamp, 'a/' || model_timestamp AS path FROM info
  UNION ALL SELECT device_id, model_timestamp, 'b/' || model_timestamp FROM parts WHERE n >= 2 AND late)""", """
newest AS (SELECT * FROM info QUALIFY row_number() OVER (PARTITION BY model_timestamp
                                                         ORDER BY created_at DESC) = 1)""")


def _registry(spark, sf_dir) -> dict:
    ts = F.col("timestamp")
    parts = (fx.readings(spark, sf_dir)
             .groupBy("device_id", F.concat_ws("_", "device_id", F.date_format(ts, "yyyyMMdd")).alias("model_timestamp"),
                      (F.hour(ts) >= 12).alias("late"))
             .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at"),
                  r6(F.stddev_samp("active_power")).alias("rmse"), r6(F.avg("active_power")).alias("r2")))
    few = F.col("n") < 2
    trained = parts.filter(~few)
    places = F.when(F.col("late"), F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    return {"runs": parts.select("device_id", "model_timestamp",
                                 F.when(few, "FAILED").otherwise("SUCCESS").alias("status"),
                                 F.col("n").cast("double").alias("duration_seconds"),
                                 F.when(few, "too few readings").alias("error_message"),
                                 F.col("first_at").alias("started_at")),
            "info": trained.select("device_id", "model_timestamp", "rmse", "r2", F.col("last_at").alias("created_at")),
            "artifacts": trained.select(F.col("device_id").alias("kind"), "model_timestamp",
                                        F.explode(places).alias("_place"))
            .select("kind", "model_timestamp", F.concat_ws("/", "_place", "model_timestamp").alias("path"))}


@register("model_runs", o.with_ctes(*_REGISTRY, """
last_runs AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY model_timestamp
                                                            ORDER BY started_at DESC) = 1)""") + """
SELECT r.device_id, r.model_timestamp, status, duration_seconds, error_message, started_at, rmse, r2
FROM last_runs r LEFT JOIN newest n ON r.model_timestamp = n.model_timestamp
""")
def model_runs(spark, sf_dir):
    """The last run of each model with its newest info row, if it has one."""
    t = _registry(spark, sf_dir)
    info = readmodels.latest(t["info"], "created_at", by=("model_timestamp",)).drop("created_at", "device_id")
    runs = readmodels.latest(t["runs"], "started_at", by=("model_timestamp",))
    return runs.join(info, "model_timestamp", "left")


@register("latest_model", o.with_ctes(*_REGISTRY) + """
SELECT * FROM info QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY created_at DESC) = 1
""")
def latest_model(spark, sf_dir):
    """The newest model-info row of each device, by its creation time."""
    return readmodels.latest(_registry(spark, sf_dir)["info"], "created_at", by=("device_id",))


@register("artifact_info", o.with_ctes(*_REGISTRY, """
last_artifact AS (SELECT * FROM artifacts QUALIFY row_number() OVER (
  PARTITION BY kind ORDER BY model_timestamp DESC, path DESC) = 1)""") + """
SELECT kind, a.model_timestamp, path, rmse, r2, created_at
FROM last_artifact a LEFT JOIN newest n ON a.model_timestamp = n.model_timestamp
""")
def artifact_info(spark, sf_dir):
    """The newest artifact of each device, out of two locations, with the newest info
    row of its model."""
    t = _registry(spark, sf_dir)
    return readmodels.artifact_info(t["artifacts"], t["info"].drop("device_id"))


@register("registry_as_of", o.with_ctes(*_REGISTRY) + """
SELECT r.device_id, r.model_timestamp, r.started_at, i.model_timestamp AS info_model, i.rmse, i.created_at
FROM runs r ASOF LEFT JOIN info i ON r.device_id = i.device_id AND i.created_at <= r.started_at
""")
def registry_as_of(spark, sf_dir):
    """Every run with the state of the registry when it began: the device's newest info
    row that is not later than the run."""
    t = _registry(spark, sf_dir)
    known = readmodels.as_of(t["runs"].select("device_id", "model_timestamp", "started_at"), t["info"],
                             by=("device_id",), at="started_at", since="created_at")
    return known.select("device_id", "model_timestamp", "started_at",
                        F.col("known.model_timestamp").alias("info_model"), F.col("known.rmse").alias("rmse"),
                        F.col("known.created_at").alias("created_at"))


_DAILY_SQL = o.with_ctes(o.READINGS, o.CAL, EXPECTED_CTE, """
runs AS (
  SELECT strftime("timestamp", '%Y%m%d') || '_000000' AS model_timestamp,
         count(*) AS num_training_samples,
         round(sqrt(avg((active_power - prediction) * (active_power - prediction))), 6) AS rmse,
         round(avg((active_power - prediction) * (active_power - prediction)), 6) AS mse,
         round(avg(abs(active_power - prediction)), 6) AS mae,
         round(1 - sum((active_power - prediction) * (active_power - prediction))
                   / (var_pop(active_power) * count(*)), 6) AS r2
  FROM forecasts GROUP BY 1
)""")


def _daily(spark, sf_dir):
    """One evaluation row per calendar day of the baseline model."""
    f = _forecasts(spark, sf_dir)
    err = F.col("active_power") - F.col("prediction")
    runs = (f.groupBy(F.concat(F.date_format("timestamp", "yyyyMMdd"), F.lit("_000000"))
                      .alias("model_timestamp"))
            .agg(F.count(F.lit(1)).alias("num_training_samples"),
                 F.avg(err * err).alias("_mse"), F.avg(F.abs(err)).alias("_mae"),
                 F.sum(err * err).alias("_sse"),
                 (F.var_pop("active_power") * F.count(F.lit(1))).alias("_sst")))
    return runs.select("model_timestamp", "num_training_samples",
                       r6(F.sqrt("_mse")).alias("rmse"), r6("_mse").alias("mse"),
                       r6("_mae").alias("mae"),
                       r6(F.lit(1) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"))


@register("daily_evaluation", _DAILY_SQL + "SELECT * FROM runs")
def daily_evaluation(spark, sf_dir):
    """Per-day evaluation of the baseline model."""
    return _daily(spark, sf_dir)


@register("table_counts", o.with_ctes(o.READINGS, o.CAL, EXPECTED_CTE, ANOMALIES_CTE, """
runs AS (SELECT DISTINCT strftime("timestamp", '%Y%m%d') AS d FROM readings)""") + """
SELECT (SELECT count(*) FROM anomalies) AS anomalies_count,
       (SELECT count(*) FROM forecasts) AS forecasts_count,
       (SELECT count(*) FROM runs) AS model_info_count
""")
def table_counts(spark, sf_dir):
    """Row counts of the anomalies, forecasts and model-info tables, counted
    as written."""
    made = {"anomalies": _anomalies(spark, sf_dir), "forecasts": _forecasts(spark, sf_dir),
            "model_info": fx.readings(spark, sf_dir).select(F.to_date("timestamp").alias("day")).distinct()}
    counted = {}
    for name, df in made.items():
        path = scratch_path(spark, f"table-{name}")
        write_parquet(df, path)
        counted[name] = spark.read.parquet(path)
    return readmodels.table_counts(**counted)
