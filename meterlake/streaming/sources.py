"""Streaming sources of reading events.

* ``file_stream``  — JSON payload files (one event per line); the offline
  stand-in for the broker and what the tests use.
* ``kafka_stream`` — a Kafka topic (needs the Kafka connector on the
  classpath; chosen explicitly, never as a silent fallback).
* ``rate_stream``  — a simulation source: the rate source's rows projected
  to one constant reading each (no join needed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import payload

# The constant simulation reading.
SIMULATED_READING = {"device_id": "meter_1", "active_power": 2.5, "reactive_power": 0.5,
                     "voltage": 230, "current": 0.01, "Sub_metering_1": 0.5,
                     "Sub_metering_2": 0.3, "Sub_metering_3": 0.2,
                     "is_injected_anomaly": False}


def file_stream(spark: SparkSession, path: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return payload.parse(reader.load(path))


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "earliest") -> DataFrame:
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribe", topic)
           .option("startingOffsets", starting_offsets)
           .load())
    return payload.parse(raw)


def rate_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    rate = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
    cols = [F.unix_seconds(F.col("timestamp")).alias("timestamp")]
    cols += [F.lit(v).alias(k) for k, v in SIMULATED_READING.items()]
    return rate.select(*cols).withColumn(
        "timestamp_dt", F.timestamp_seconds("timestamp").cast("timestamp_ntz"))


def publish_files(readings: DataFrame, path: str) -> None:
    """Write readings as JSON payload lines (the file 'topic')."""
    payload.encode(readings).write.mode("overwrite").text(path)


def publish_kafka(readings: DataFrame, bootstrap_servers: str, topic: str) -> None:
    (payload.encode(readings).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
