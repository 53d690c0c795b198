"""Streaming and document round-trip queries.

Each writes its intermediate data under the session's checkpoint
directory (shared storage on a cluster), runs the stream with
``availableNow`` and returns the result table as a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import profiles
from ..session import release, scratch_path
from ..sinks.tables import create_result_tables, read_result, write_document
from ..sources import document
from ..sources import fixtures as fx
from ..streaming import detect as sdetect
from ..streaming import payload
from ..streaming import sources as ssrc
from . import oracle as o
from .catalog import register

_EVENT_SQL = o.EVENTS_D3

_D6 = ['"timestamp"', "device_id", "active_power", "reactive_power", "voltage", '"current"',
       "Sub_metering_1", "Sub_metering_2", "Sub_metering_3", "is_injected_anomaly"]


@register("stream_json_parse", o.with_ctes(o.READINGS, _EVENT_SQL) + """
SELECT *, make_timestamp("timestamp" * 1000000) AS timestamp_dt FROM events_d3
""")
def stream_json_parse(spark, sf_dir):
    """Readings -> JSON payload files -> file stream -> parsed events
    (D3 + timestamp_dt), drained with availableNow into a Parquet sink."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("payload", "parsed", "ckpt"))
    ssrc.publish_files(fx.readings(spark, sf_dir), src)
    sdetect.run_available(ssrc.file_stream(spark, src), sink, ckpt)
    release(spark, src, ckpt)
    return spark.read.parquet(sink)


@register("stream_3sigma", o.with_ctes(o.READINGS, _EVENT_SQL, o.SCORED) + f"""
SELECT {", ".join(_D6)},
       (active_power < lower_bound OR active_power > upper_bound) AS is_anomaly,
       round(mean, 6) AS mean, round(stddev, 6) AS stddev,
       round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound
FROM scored
WHERE (active_power < lower_bound OR active_power > upper_bound) OR is_injected_anomaly
""")
def stream_3sigma(spark, sf_dir):
    """The detector as a Structured Streaming query: JSON payload files ->
    foreachBatch 3-sigma detection -> anomalies table partitioned by
    batch_id (one availableNow batch holds every file, so it equals the
    batch query)."""
    src, table, ckpt = (scratch_path(spark, n) for n in ("payload", "anomalies", "ckpt"))
    ssrc.publish_files(fx.readings(spark, sf_dir), src)
    q, _ = sdetect.start_detection(ssrc.file_stream(spark, src), table, ckpt, available_now=True)
    q.awaitTermination()
    release(spark, src, ckpt)
    out = read_result(spark, table, "anomalies")
    return out.select("timestamp", "device_id", "active_power", "reactive_power", "voltage",
                      "current", "Sub_metering_1", "Sub_metering_2", "Sub_metering_3",
                      "is_injected_anomaly", "is_anomaly", r6("mean").alias("mean"),
                      r6("stddev").alias("stddev"), r6("lower_bound").alias("lower_bound"),
                      r6("upper_bound").alias("upper_bound"))


@register("anomalies_table", o.with_ctes(o.READINGS, o.EVENTS_D3, o.SCORED) + """
SELECT "timestamp", device_id, active_power, is_anomaly FROM (
  SELECT *, (active_power < lower_bound OR active_power > upper_bound) AS is_anomaly FROM scored) x
WHERE is_anomaly OR is_injected_anomaly
""")
def anomalies_table(spark, sf_dir):
    """The detector's rows read by the name of the SQL table it registers its
    partitions with."""
    src, where, ckpt = (scratch_path(spark, n) for n in ("payload", "results", "ckpt"))
    name = f"meterlake_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{where}'")
    create_result_tables(spark, where, name)
    ssrc.publish_files(fx.readings(spark, sf_dir), src)
    q, _ = sdetect.start_detection(ssrc.file_stream(spark, src), f"{where}/anomalies", ckpt,
                                   available_now=True, table=f"{name}.anomalies")
    q.awaitTermination()
    release(spark, src, ckpt)
    return spark.table(f"{name}.anomalies").select("timestamp", "device_id", "active_power", "is_anomaly")


@register("payload_rejects", o.with_ctes(o.READINGS) + """
SELECT count(*) AS n_payloads, CAST(count_if(event_id % 31 = 1 OR event_id % 37 = 2 OR event_id % 41 = 3)
         AS BIGINT) AS n_rejected
FROM readings
""")
def payload_rejects(spark, sf_dir):
    """Count of payloads that cannot be used: broken JSON, no device, NULL."""
    e = F.col("event_id")
    p = fx.readings(spark, sf_dir).select("event_id", payload.event_json().alias("value"))
    bad = (F.when(e % 31 == 1, F.substring("value", 1, 25)).when(e % 37 == 2, F.lit('{"timestamp": 5}'))
           .when(e % 41 == 3, F.lit(None)).otherwise(F.col("value")))
    return payload.rejects(p.select(bad.alias("value")))


def _document_sql() -> str:
    parts = []
    hourly = {"avg_active_power": "avg(active_power)",
              "stddev_active_power": "stddev_samp(active_power)",
              "min_active_power": "min(active_power)", "max_active_power": "max(active_power)",
              "avg_voltage": "avg(voltage)", "stddev_voltage": "stddev_samp(voltage)",
              "min_voltage": "min(voltage)", "max_voltage": "max(voltage)"}
    for m, agg in hourly.items():
        parts.append(f"SELECT 'hourly_stats' AS section, hour_of_day, '{m}' AS metric, "
                     f"round(CAST(round({agg}, 6) AS DOUBLE), 6) AS value FROM cal GROUP BY hour_of_day")
    parts.append("SELECT 'weekday_stats', hour_of_day, 'weekday_avg_power', round(avg(active_power), 6) "
                 "FROM cal WHERE day_of_week BETWEEN 2 AND 6 GROUP BY hour_of_day")
    parts.append("SELECT 'weekend_stats', hour_of_day, 'weekend_avg_power', round(avg(active_power), 6) "
                 "FROM cal WHERE day_of_week IN (1, 7) GROUP BY hour_of_day")
    seasons = {"winter": "(12, 1, 2)", "summer": "(6, 7, 8)", "other_season": "(3, 4, 5, 9, 10, 11)"}
    for s, months in seasons.items():
        parts.append(f"SELECT '{s}_stats', -1, '{s}_avg_power', "
                     f"round(avg(CASE WHEN \"month\" IN {months} THEN active_power END), 6) FROM cal")
        parts.append(f"SELECT '{s}_stats', -1, '{s}_stddev_power', "
                     f"round(stddev_samp(CASE WHEN \"month\" IN {months} THEN active_power END), 6) FROM cal")
    for m, agg in {"overall_avg_power": "avg(active_power)",
                   "overall_stddev_power": "stddev_samp(active_power)",
                   "overall_min_power": "min(active_power)",
                   "overall_max_power": "max(active_power)"}.items():
        parts.append(f"SELECT 'overall_stats', -1, '{m}', round({agg}, 6) FROM cal")
    return o.with_ctes(o.READINGS, o.CAL) + "\nUNION ALL\n".join(parts)


@register("stats_document", _document_sql())
def stats_document(spark, sf_dir):
    """One profile pass -> nested statistics document -> JSON file ->
    read back with key validation -> tidy (section, hour, metric, value)."""
    path = scratch_path(spark, "statistics")
    write_document(profiles.statistics_document(fx.readings(spark, sf_dir)), path)
    return document.document_rows(document.read_document(spark, path))
