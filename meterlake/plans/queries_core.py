"""Detection and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import anomaly, device_stats, profiles
from ..session import scratch_path
from ..sources import fixtures as fx
from . import oracle as o
from .catalog import register
from .joins import kept_lookup

READING_COLS = ["event_id", "timestamp", "device_id", "active_power", "reactive_power",
                "voltage", "current", "Sub_metering_1", "Sub_metering_2", "Sub_metering_3",
                "is_injected_anomaly"]
_READING_SQL = ('event_id, "timestamp", device_id, active_power, reactive_power, voltage, '
                '"current", Sub_metering_1, Sub_metering_2, Sub_metering_3, is_injected_anomaly')


def _anomaly_output(df, extra=()):
    return df.select(*READING_COLS, *extra, "is_anomaly", r6("mean").alias("mean"),
                     r6("stddev").alias("stddev"), r6("lower_bound").alias("lower_bound"),
                     r6("upper_bound").alias("upper_bound"))


def _anomaly_sql(keys: str, key_expr: str, extra: str = "") -> str:
    return o.with_ctes(o.READINGS, f"""
base AS (SELECT *, {key_expr} FROM readings),
stats AS (
  SELECT {keys}, avg(active_power) AS mean, stddev_samp(active_power) AS stddev
  FROM base GROUP BY {keys} HAVING count(active_power) >= 3
),
scored AS (
  SELECT b.*, s.mean, s.stddev, s.mean - 3 * s.stddev AS lower_bound,
         s.mean + 3 * s.stddev AS upper_bound
  FROM base b JOIN stats s USING ({keys})
)""") + f"""
SELECT {_READING_SQL}{extra},
       (active_power < lower_bound OR active_power > upper_bound) AS is_anomaly,
       round(mean, 6) AS mean, round(stddev, 6) AS stddev,
       round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound
FROM scored
WHERE (active_power < lower_bound OR active_power > upper_bound) OR is_injected_anomaly
"""


@register("anomaly_3sigma", _anomaly_sql("device_id", "1 AS _one"))
def anomaly_3sigma(spark, sf_dir):
    """Per-device 3-sigma outliers (k=3, min 3 readings) plus injected rows."""
    return _anomaly_output(anomaly.detect(fx.readings(spark, sf_dir)))


@register("anomaly_3sigma_by_day",
          _anomaly_sql("device_id, day", "strftime(\"timestamp\", '%Y-%m-%d') AS day", ", day"))
def anomaly_3sigma_by_day(spark, sf_dir):
    """Same rule with statistics per (device, calendar day): the batch
    analogue of memoryless per-micro-batch statistics."""
    r = fx.readings(spark, sf_dir).withColumn("day", F.date_format("timestamp", "yyyy-MM-dd"))
    return _anomaly_output(anomaly.detect(r, keys=("device_id", "day")), extra=("day",))


def _merged_detect(spark, sf_dir):
    """Outliers by statistics that were merged from daily batches of moments."""
    r = fx.readings(spark, sf_dir)
    path = scratch_path(spark, "moments")
    device_stats.add_batch(device_stats.daily_moments(r), path, F.date_format("day", "yyyyMMdd").cast("long"))
    stats = kept_lookup(device_stats.statistics(device_stats.read_moments(spark, path)), "device-stats")
    return anomaly.detect(r, stats=stats, keep=True)


@register("merged_3sigma", _anomaly_sql("device_id", "1 AS _one"))
def merged_3sigma(spark, sf_dir):
    """The 3-sigma outliers by statistics merged over days: equal to those of the whole table."""
    return _anomaly_output(_merged_detect(spark, sf_dir))


@register("anomaly_batch_counts", o.with_ctes(o.READINGS, """
stats AS (
  SELECT device_id, avg(active_power) AS mean, stddev_samp(active_power) AS stddev
  FROM readings GROUP BY device_id HAVING count(active_power) >= 3
),
found AS (
  SELECT r."timestamp", r.device_id,
         (active_power < mean - 3 * stddev OR active_power > mean + 3 * stddev) AS is_anomaly
  FROM readings r JOIN stats USING (device_id)
  WHERE (active_power < mean - 3 * stddev OR active_power > mean + 3 * stddev) OR is_injected_anomaly
)""") + """
SELECT strftime("timestamp", '%Y-%m-%d') AS day, count(*) AS n_rows,
       CAST(count_if(is_anomaly) AS BIGINT) AS n_anomalies,
       count(DISTINCT device_id) AS n_devices
FROM found GROUP BY 1
""")
def anomaly_batch_counts(spark, sf_dir):
    """Rows reported for each daily batch."""
    found = _merged_detect(spark, sf_dir)
    return found.groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_anomaly").alias("n_anomalies"),
        F.countDistinct("device_id").alias("n_devices"))


@register("anomaly_quality", o.with_ctes(o.READINGS, """
stats AS (
  SELECT device_id, avg(active_power) AS mean, stddev_samp(active_power) AS stddev
  FROM readings GROUP BY device_id HAVING count(active_power) >= 3
),
flags AS (
  SELECT coalesce(r.active_power < s.mean - 3 * s.stddev OR r.active_power > s.mean + 3 * s.stddev,
                  false) AS f,
         coalesce(r.is_injected_anomaly, false) AS l
  FROM readings r LEFT JOIN stats s USING (device_id)
),
agg AS (
  SELECT count(*) AS n_readings, CAST(count_if(f) AS BIGINT) AS n_flagged,
         CAST(count_if(l) AS BIGINT) AS n_injected,
         CAST(count_if(f AND l) AS BIGINT) AS true_positives,
         CAST(count_if(f AND NOT l) AS BIGINT) AS false_positives,
         CAST(count_if(NOT f AND l) AS BIGINT) AS false_negatives
  FROM flags
)""") + """
SELECT *, round(true_positives / nullif(n_flagged, 0), 6) AS "precision",
       round(true_positives / nullif(n_injected, 0), 6) AS recall
FROM agg
""")
def anomaly_quality(spark, sf_dir):
    """Precision / recall of the 3-sigma flag against the injected label."""
    return anomaly.quality(fx.readings(spark, sf_dir))


_HOURLY_SQL_MEASURES = """
       round(avg(active_power), 6) AS avg_active_power,
       round(stddev_samp(active_power), 6) AS stddev_active_power,
       min(active_power) AS min_active_power, max(active_power) AS max_active_power,
       round(avg(voltage), 6) AS avg_voltage, round(stddev_samp(voltage), 6) AS stddev_voltage,
       min(voltage) AS min_voltage, max(voltage) AS max_voltage"""


@register("hourly_profile", o.with_ctes(o.READINGS, o.CAL) + f"""
SELECT hour_of_day, {_HOURLY_SQL_MEASURES}
FROM cal GROUP BY hour_of_day ORDER BY hour_of_day
""")
def hourly_profile(spark, sf_dir):
    return profiles.hourly_profile(fx.readings(spark, sf_dir))


@register("weekday_profile", o.with_ctes(o.READINGS, o.CAL) + """
SELECT hour_of_day, round(avg(active_power), 6) AS weekday_avg_power
FROM cal WHERE day_of_week BETWEEN 2 AND 6 GROUP BY hour_of_day ORDER BY hour_of_day
""")
def weekday_profile(spark, sf_dir):
    return profiles.weekday_profile(fx.readings(spark, sf_dir))


@register("weekend_profile", o.with_ctes(o.READINGS, o.CAL) + """
SELECT hour_of_day, round(avg(active_power), 6) AS weekend_avg_power
FROM cal WHERE day_of_week IN (1, 7) GROUP BY hour_of_day ORDER BY hour_of_day
""")
def weekend_profile(spark, sf_dir):
    return profiles.weekend_profile(fx.readings(spark, sf_dir))


@register("season_profile", o.with_ctes(o.LINEITEM_READINGS) + """
SELECT season, count(active_power) AS n, round(avg(active_power), 6) AS avg_power,
       round(stddev_samp(active_power), 6) AS stddev_power
FROM (
  SELECT active_power,
         CASE WHEN month("timestamp") IN (12, 1, 2) THEN 'winter'
              WHEN month("timestamp") IN (6, 7, 8) THEN 'summer'
              WHEN month("timestamp") IN (3, 4, 5, 9, 10, 11) THEN 'other' END AS season
  FROM li_readings
) s WHERE season IS NOT NULL GROUP BY season
""")
def season_profile(spark, sf_dir):
    """Winter / summer / other-season load on the multi-year lineitem series."""
    return profiles.season_profile(fx.lineitem_readings(spark, sf_dir))


@register("overall_profile", o.with_ctes(o.READINGS) + """
SELECT round(avg(active_power), 6) AS overall_avg_power,
       round(stddev_samp(active_power), 6) AS overall_stddev_power,
       min(active_power) AS overall_min_power, max(active_power) AS overall_max_power
FROM readings
""")
def overall_profile(spark, sf_dir):
    return profiles.overall_profile(fx.readings(spark, sf_dir))


_DESCRIBE_COLS = ["active_power", "reactive_power", "voltage", "current",
                  "Sub_metering_1", "Sub_metering_2", "Sub_metering_3"]


def _describe_sql() -> str:
    parts = []
    for c in _DESCRIBE_COLS:
        x = f'CAST("{c}" AS DOUBLE)'
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS count, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS stddev, round(min({x}), 6) AS min, "
            f"round(max({x}), 6) AS max FROM readings")
    return o.with_ctes(o.READINGS) + "\nUNION ALL\n".join(parts)


@register("describe_readings", _describe_sql())
def describe_readings(spark, sf_dir):
    """count / mean / stddev / min / max of every measure (tidy describe)."""
    return profiles.describe_columns(fx.readings(spark, sf_dir), _DESCRIBE_COLS)


@register("hourly_load", o.with_ctes(o.READINGS) + """
SELECT CAST(hour("timestamp") AS INTEGER) AS "hour",
       round(sum(active_power), 6) AS sum_active_power, round(avg(voltage), 6) AS avg_voltage
FROM readings WHERE active_power > 0 GROUP BY 1
""")
def hourly_load(spark, sf_dir):
    """The reference's benchmark query: hourly load over positive readings."""
    return profiles.hourly_load(fx.readings(spark, sf_dir))


@register("anomaly_with_nan", o.with_ctes(o.READINGS, """
faulty AS (SELECT event_id, device_id, is_injected_anomaly,
                  CASE WHEN event_id % 29 = 3 THEN NULL ELSE active_power END AS p FROM readings),
stats AS (SELECT device_id, avg(p) AS mean, stddev_samp(p) AS stddev FROM faulty
          GROUP BY device_id HAVING count(p) >= 3)""") + """
SELECT event_id, f.device_id, (p < mean - 3 * stddev OR p > mean + 3 * stddev) AS is_anomaly
FROM faulty f JOIN stats s ON f.device_id = s.device_id
WHERE (p < mean - 3 * stddev OR p > mean + 3 * stddev) OR is_injected_anomaly
""")
def anomaly_with_nan(spark, sf_dir):
    """3-sigma detection where some readings are NaN: they count as missing."""
    r = fx.readings(spark, sf_dir)
    nan = F.when(F.col("event_id") % 29 == 3, F.lit(float("nan"))).otherwise(F.col("active_power"))
    return anomaly.detect(r.withColumn("active_power", nan)).select("event_id", "device_id", "is_anomaly")
