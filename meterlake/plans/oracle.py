"""DuckDB SQL of the adapter views, used to write each query's oracle.

The expressions mirror ``sources.fixtures`` one to one.  Spark's
``dayofweek`` is 1 = Sunday; DuckDB's ``isodow`` is 7 = Sunday, so
``isodow % 7 + 1`` gives Spark's numbering.
"""

READINGS = """
readings AS (
  SELECT event_id,
         ts AS "timestamp",
         'meter_' || CAST(user_id AS VARCHAR) AS device_id,
         value AS active_power,
         value * 0.2 AS reactive_power,
         CAST(220 + k % 21 AS INTEGER) AS voltage,
         value / CAST(220 + k % 21 AS INTEGER) AS "current",
         value * 0.3 AS Sub_metering_1,
         value * 0.2 AS Sub_metering_2,
         value * 0.1 AS Sub_metering_3,
         (event_type = 'error' AND k < 25) AS is_injected_anomaly
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

CAL = """
cal AS (
  SELECT *, CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
         CAST(isodow("timestamp") % 7 + 1 AS INTEGER) AS day_of_week,
         CAST(month("timestamp") AS INTEGER) AS "month"
  FROM readings
)"""

RAW = """
raw_readings AS (
  SELECT event_id,
         CASE WHEN event_id % 23 = 5 THEN '' ELSE strftime("timestamp", '%d/%m/%Y') END AS "Date",
         strftime("timestamp", '%H:%M:%S') AS "Time",
         CASE WHEN event_id % 17 = 0 THEN '?' ELSE CAST(active_power AS VARCHAR) END AS Global_active_power,
         CASE WHEN event_id % 17 = 0 THEN '?' ELSE CAST(reactive_power AS VARCHAR) END AS Global_reactive_power,
         CASE WHEN event_id % 17 = 0 THEN '?' ELSE CAST(voltage AS VARCHAR) END AS Voltage,
         CASE WHEN event_id % 17 = 0 THEN '?' ELSE CAST("current" AS VARCHAR) END AS Global_intensity,
         CASE WHEN event_id % 17 = 0 THEN '?' ELSE CAST(Sub_metering_1 AS VARCHAR) END AS Sub_metering_1,
         CASE WHEN event_id % 17 = 0 THEN '?' ELSE CAST(Sub_metering_2 AS VARCHAR) END AS Sub_metering_2,
         CASE WHEN event_id % 17 = 0 THEN '?' ELSE CAST(Sub_metering_3 AS VARCHAR) END AS Sub_metering_3
  FROM readings
)"""

# raw text -> typed, before any imputation (P3 + P7)
TYPED = """
typed AS (
  SELECT event_id,
         try_strptime("Date" || ' ' || "Time", '%d/%m/%Y %H:%M:%S') AS "timestamp",
         TRY_CAST(Global_active_power AS DOUBLE) AS Global_active_power,
         TRY_CAST(Global_reactive_power AS DOUBLE) AS Global_reactive_power,
         TRY_CAST(Voltage AS DOUBLE) AS Voltage,
         TRY_CAST(Global_intensity AS DOUBLE) AS Global_intensity,
         TRY_CAST(Sub_metering_1 AS DOUBLE) AS Sub_metering_1,
         TRY_CAST(Sub_metering_2 AS DOUBLE) AS Sub_metering_2,
         TRY_CAST(Sub_metering_3 AS DOUBLE) AS Sub_metering_3
  FROM raw_readings
)"""

REQUESTS = """
requests AS (
  SELECT event_id,
         CASE WHEN event_id % 13 = 0 THEN 600.0 ELSE CAST(voltage AS DOUBLE) END AS Voltage,
         "current", Sub_metering_1, Sub_metering_2, Sub_metering_3,
         CASE WHEN event_id % 19 = 0 THEN 24 ELSE CAST(hour("timestamp") AS INTEGER) END AS "hour",
         CAST(isodow("timestamp") % 7 + 1 AS INTEGER) AS day_of_week,
         CAST(month("timestamp") AS INTEGER) AS "month",
         active_power
  FROM readings
)"""

LINEITEM_READINGS = """
li_readings AS (
  SELECT l_shipdate AS "timestamp", l_extendedprice AS active_power FROM lineitem
)"""


EVENTS_D3 = """
events_d3 AS (
  SELECT CAST(floor(epoch_us("timestamp") / 1000000) AS BIGINT) AS "timestamp", device_id,
         active_power, reactive_power, voltage, "current", Sub_metering_1, Sub_metering_2,
         Sub_metering_3, is_injected_anomaly
  FROM readings
)"""

SCORED = """
stats AS (
  SELECT device_id, avg(active_power) AS mean, stddev_samp(active_power) AS stddev
  FROM events_d3 GROUP BY device_id HAVING count(active_power) >= 3
),
scored AS (
  SELECT e.*, s.mean, s.stddev, s.mean - 3 * s.stddev AS lower_bound,
         s.mean + 3 * s.stddev AS upper_bound
  FROM events_d3 e JOIN stats s USING (device_id)
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"
