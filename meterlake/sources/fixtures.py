"""Adapter views over the driver tables.

The verify tables are not meter exports, so a reading, a raw text export and
a scoring request are *derived* from ``events`` with plain column
expressions (the same expressions are written in DuckDB SQL in
``plans.oracle``).  Every row of ``events`` becomes one reading; nothing is
filtered.  The modulo rules only inject faults (blank dates, '?' tokens,
out-of-range requests) into some rows, they never drop rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _k(props: str = "props"):
    # one JSON path lookup per row: cheaper than from_json's row decoder,
    # same value (non-integer or missing k -> NULL)
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as meter readings (one row per event)."""
    ev = table(spark, sf_dir, "events")
    k = _k()
    voltage = (F.lit(220) + k % 21).cast("int")
    return (ev.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("meter_"), F.col("user_id").cast("string")).alias("device_id"),
        F.col("value").alias("active_power"),
        (F.col("value") * 0.2).alias("reactive_power"),
        voltage.alias("voltage"),
        (F.col("value") / voltage).alias("current"),
        (F.col("value") * 0.3).alias("Sub_metering_1"),
        (F.col("value") * 0.2).alias("Sub_metering_2"),
        (F.col("value") * 0.1).alias("Sub_metering_3"),
        ((F.col("event_type") == "error") & (k < 25)).alias("is_injected_anomaly"),
    ))


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``readings`` rendered as a raw text export (all columns STRING):
    blank Date on some rows, '?' tokens on others."""
    r = readings(spark, sf_dir)
    blank_date = (F.col("event_id") % 23) == 5
    unknown = (F.col("event_id") % 17) == 0

    def text(c):
        return F.when(unknown, F.lit("?")).otherwise(F.col(c).cast("string"))

    return r.select(
        "event_id",
        F.when(blank_date, F.lit("")).otherwise(
            F.date_format("timestamp", "dd/MM/yyyy")).alias("Date"),
        F.date_format("timestamp", "HH:mm:ss").alias("Time"),
        text("active_power").alias("Global_active_power"),
        text("reactive_power").alias("Global_reactive_power"),
        text("voltage").alias("Voltage"),
        text("current").alias("Global_intensity"),
        text("Sub_metering_1").alias("Sub_metering_1"),
        text("Sub_metering_2").alias("Sub_metering_2"),
        text("Sub_metering_3").alias("Sub_metering_3"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests derived from readings; some rows carry an
    out-of-range voltage (600) or hour (24) to exercise validation."""
    r = readings(spark, sf_dir)
    bad_voltage = (F.col("event_id") % 13) == 0
    bad_hour = (F.col("event_id") % 19) == 0
    return r.select(
        "event_id",
        F.when(bad_voltage, F.lit(600.0)).otherwise(F.col("voltage").cast("double")).alias("Voltage"),
        F.col("current"),
        "Sub_metering_1", "Sub_metering_2", "Sub_metering_3",
        F.when(bad_hour, F.lit(24)).otherwise(F.hour("timestamp")).alias("hour"),
        F.dayofweek("timestamp").alias("day_of_week"),
        F.month("timestamp").alias("month"),
        F.col("active_power"),
    )


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a multi-year load series: ship date -> timestamp,
    extended price -> load.  Used where the events span a single month
    (season profiles)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_shipdate").alias("timestamp"),
                     F.col("l_extendedprice").alias("active_power"))
