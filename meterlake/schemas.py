"""Fixed schemas of the data model (raw readings, clean readings, reading
events, result tables, scoring requests)."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column names of a raw meter export and the measure
# names of the clean table.
RAW_COLUMNS = ["Date", "Time", "Global_active_power", "Global_reactive_power",
               "Voltage", "Global_intensity", "Sub_metering_1", "Sub_metering_2",
               "Sub_metering_3"]

# Accepted alternative spellings for each raw column.
RAW_ALIASES = {
    "Date": ["date"],
    "Time": ["time"],
    "Global_active_power": ["active_power", "globalactivepower"],
    "Global_reactive_power": ["reactive_power", "globalreactivepower"],
    "Voltage": ["voltage"],
    "Global_intensity": ["current", "globalintensity", "intensity"],
    "Sub_metering_1": ["submetering_1", "submetering1", "sub_metering1"],
    "Sub_metering_2": ["submetering_2", "submetering2", "sub_metering2"],
    "Sub_metering_3": ["submetering_3", "submetering3", "sub_metering3"],
}

# raw measure -> clean measure name
CLEAN_NAMES = {
    "Global_active_power": "active_power",
    "Global_reactive_power": "reactive_power",
    "Voltage": "Voltage",
    "Global_intensity": "current",
    "Sub_metering_1": "Sub_metering_1",
    "Sub_metering_2": "Sub_metering_2",
    "Sub_metering_3": "Sub_metering_3",
}
MEASURES = list(CLEAN_NAMES.values())

# D1: raw export, typed explicitly as text (no schema inference pass).
RAW_READINGS = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# D2: clean readings.
CLEAN_READINGS = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in MEASURES])

# Fixed values (the layouts below must match the result tables).
# D3: one reading event as carried in a stream payload.
READING_EVENT = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("active_power", T.DoubleType()),
    T.StructField("reactive_power", T.DoubleType()),
    T.StructField("voltage", T.IntegerType()),
    T.StructField("current", T.DoubleType()),
    T.StructField("Sub_metering_1", T.DoubleType()),
    T.StructField("Sub_metering_2", T.DoubleType()),
    T.StructField("Sub_metering_3", T.DoubleType()),
    T.StructField("is_injected_anomaly", T.BooleanType()),
])

# D6: anomalies result table (partitioned by batch_id when written by a stream).
ANOMALY_COLUMNS = ["timestamp", "device_id", "active_power", "reactive_power", "voltage",
                   "current", "Sub_metering_1", "Sub_metering_2", "Sub_metering_3",
                   "is_anomaly", "is_injected_anomaly", "mean", "stddev",
                   "lower_bound", "upper_bound", "detection_time"]

# D6 as a table written by the stream.
ANOMALIES = T.StructType(
    READING_EVENT.fields[:-1] + [T.StructField("is_anomaly", T.BooleanType())] + READING_EVENT.fields[-1:]
    + [T.StructField(c, T.DoubleType()) for c in ("mean", "stddev", "lower_bound", "upper_bound")]
    + [T.StructField("detection_time", T.TimestampType()), T.StructField("batch_id", T.LongType())])

# D7: forecasts; rows of scored requests have no actual value.
FORECASTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("active_power", T.DoubleType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

# D8: model info.
MODEL_INFO = T.StructType([
    T.StructField("model_timestamp", T.StringType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("mse", T.DoubleType()),
    T.StructField("coefficients", T.StringType()),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("num_training_samples", T.LongType()),
    T.StructField("created_at", T.TimestampType()),
])

# D9: training runs.
TRAINING_RUNS = T.StructType([
    T.StructField("model_timestamp", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("config", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("error_message", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

# D12: scoring request.
SCORING_REQUEST = T.StructType([
    T.StructField("Voltage", T.DoubleType(), True),
    T.StructField("current", T.DoubleType(), True),
    T.StructField("Sub_metering_1", T.DoubleType(), True),
    T.StructField("Sub_metering_2", T.DoubleType(), True),
    T.StructField("Sub_metering_3", T.DoubleType(), True),
    T.StructField("hour", T.IntegerType(), True),
    T.StructField("day_of_week", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
])

FEATURE_COLUMNS = ["Voltage", "current", "Sub_metering_1", "Sub_metering_2",
                   "Sub_metering_3", "hour", "day_of_week", "month"]
