"""Read-side queries over result tables (anomalies, forecasts, model info)
and validation of scoring requests.

Top-k lists are ``orderBy(...).limit(k)`` so Spark plans
``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge); the
full history is a distributed range sort.  Nothing is gathered on the
driver.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import col

# Validation rules and messages for scoring requests.
VALIDATION_RULES = [
    ("Voltage", 0.0, 500.0, "Voltage should be between 0 and 500V"),
    ("current", 0.0, 100.0, "Current should be between 0 and 100A"),
    ("Sub_metering_1", 0.0, None, "Sub_metering_1 should be a positive value"),
    ("Sub_metering_2", 0.0, None, "Sub_metering_2 should be a positive value"),
    ("Sub_metering_3", 0.0, None, "Sub_metering_3 should be a positive value"),
    ("hour", 0, 23, "Hour should be between 0 and 23"),
    ("day_of_week", 1, 7, "Day of week should be between 1 and 7"),
    ("month", 1, 12, "Month should be between 1 and 12"),
]
# Value used for an absent field, and the parse-error messages.
FIELD_DEFAULTS = {"Voltage": 0.0, "current": 0.0, "Sub_metering_1": 0.0,
                  "Sub_metering_2": 0.0, "Sub_metering_3": 0.0, "hour": 0,
                  "day_of_week": 1, "month": 1}
PARSE_MESSAGES = {"Voltage": "Voltage must be a valid number",
                  "current": "Current must be a valid number",
                  "Sub_metering_1": "Sub_metering_1 must be a valid number",
                  "Sub_metering_2": "Sub_metering_2 must be a valid number",
                  "Sub_metering_3": "Sub_metering_3 must be a valid number",
                  "hour": "Hour must be a valid integer",
                  "day_of_week": "Day of week must be a valid integer",
                  "month": "Month must be a valid integer"}
INTEGER_FIELDS = ("hour", "day_of_week", "month")


def validate(requests: DataFrame) -> DataFrame:
    """Type every request field (text or number), apply the range rules and
    attach ``errors`` (array of messages), ``n_errors``, ``error_message``
    and ``is_valid``.  Absent fields take the form defaults; unparsable
    text gets a parse message and the default value."""
    typed, parse_messages, messages = {}, [], []
    for name, default in FIELD_DEFAULTS.items():
        raw = F.col(name)
        target = "int" if name in INTEGER_FIELDS else "double"
        parsed = raw.try_cast(target)
        bad_text = raw.isNotNull() & parsed.isNull()
        parse_messages.append(F.when(bad_text, F.lit(PARSE_MESSAGES[name])))
        typed[name] = F.coalesce(parsed, F.lit(default).cast(target))
    # parse errors are judged on the raw values, before the fields are retyped
    out = requests.withColumn("_parse_errors", F.array(*parse_messages)).withColumns(typed)
    for name, lo, hi, msg in VALIDATION_RULES:
        c = F.col(name)
        bad = c < lo if hi is None else (c < lo) | (c > hi)
        messages.append(F.when(bad, F.lit(msg)))
    errors = F.array_compact(F.concat(F.col("_parse_errors"), F.array(*messages)))
    return (out.withColumn("errors", errors)
            .withColumn("n_errors", F.size("errors"))
            .withColumn("error_message", F.when(F.col("n_errors") > 0,
                                                F.array_join("errors", ", ")))
            .withColumn("is_valid", F.col("n_errors") == 0)
            .drop("_parse_errors"))


def anomaly_feed(anomalies: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Anomaly rows in the feed shape: timestamp, value, type tag."""
    return anomalies.select(F.col(ts).alias("timestamp"), F.col("active_power").alias("value"),
                            F.lit("anomaly").alias("type"), "device_id", "is_anomaly",
                            "is_injected_anomaly", *(["event_id"] if "event_id" in anomalies.columns else []))


def forecast_feed(forecasts: DataFrame) -> DataFrame:
    return forecasts.select("timestamp", F.col("prediction").alias("value"),
                            F.lit("forecast").alias("type"), "active_power",
                            *(["event_id"] if "event_id" in forecasts.columns else []))


def newest(df: DataFrame, k: int | None, ts: str = "timestamp",
           tie: str | None = "event_id") -> DataFrame:
    """Newest first; ``k`` rows (top-k) or the whole history (k=None)."""
    order = [F.col(ts).desc_nulls_last()] + ([F.col(tie).desc()] if tie and tie in df.columns else [])
    out = df.orderBy(*order)
    return out.limit(k) if k else out


def write_by_day(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """A result table laid out by day, for :func:`newest_by_day`."""
    df.withColumn("day", F.to_date(ts)).write.mode("overwrite").partitionBy("day").parquet(path)


def newest_by_day(table: DataFrame, k: int, ts: str = "timestamp", tie: str | None = "event_id",
                  day: str = "day") -> DataFrame:
    """The k newest rows of a table that is laid out by day: the newest days are counted,
    twice as many each time, until they hold k rows; the others are never opened.  The days
    come from the table's list of files.  Rows without a time (the NULL day) come last."""
    found = {unquote(m.group(1)) for f in table.inputFiles() if (m := re.search(rf"/{re.escape(day)}=([^/]+)/", f))}
    days = sorted(d for d in found if d != "__HIVE_DEFAULT_PARTITION__")
    take = 1
    while take < len(days):
        wanted = table.filter(F.col(day) >= F.lit(days[-take]).cast("date"))
        if wanted.limit(k).count() == k:
            return newest(wanted, k, ts, tie)
        take *= 2
    return newest(table, k, ts, tie)


def formatted_time(c: str | Column = "timestamp") -> Column:
    """Display text 'yyyy-MM-dd HH:mm:ss'; unparsable text passes through."""
    c = col(c)
    return F.coalesce(F.date_format(c.try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss"),
                      c.cast("string"))


def latest(df: DataFrame, *order_cols: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The row with the largest ``order_cols`` (of each ``by``): one aggregate
    of ``max_by`` over a struct, no sort."""
    row = F.max_by(F.struct(*df.columns), F.struct(*order_cols)).alias("_r")
    return df.groupBy(*by).agg(row).select("_r.*")


def latest_artifact(artifacts: DataFrame) -> DataFrame:
    """The newest artifact of each kind (rows: kind, model_timestamp, path)."""
    return latest(artifacts, "model_timestamp", "path", by=("kind",))


def artifact_info(artifacts: DataFrame, info: DataFrame) -> DataFrame:
    """The newest artifact of each kind with the newest info row of its model."""
    newest_info = latest(info, "created_at", by=("model_timestamp",))
    return latest_artifact(artifacts).join(newest_info, "model_timestamp", "left")


def as_of(events: DataFrame, states: DataFrame, by: tuple[str, ...], at: str, since: str) -> DataFrame:
    """``events`` plus ``known``: the row of ``states`` with the largest ``since`` that is
    not later than the event's ``at``, of the same ``by`` (null if there is none; of equal
    ones the row that is largest in all columns).  One shuffle of both by ``by`` and time
    order within it; a window keeps no more than the last state.  Events without a time
    know nothing."""
    row = F.struct(F.col(since), *[c for c in states.columns if c != since])
    both = (events.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(at).alias("_at"),
                          F.lit(1).alias("_kind"), F.struct(*events.columns).alias("_event"), F.lit(None).alias("_state"))
            .unionByName(states.filter(F.col(since).isNotNull())
                         .select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(since).alias("_at"),
                                 F.lit(0).alias("_kind"), F.lit(None).alias("_event"), row.alias("_state"))))
    # states before events of the same time
    so_far = (Window.partitionBy(*[f"_by{i}" for i in range(len(by))])
              .orderBy(F.col("_at").asc_nulls_first(), "_kind", "_state")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = F.last("_state", ignorenulls=True).over(so_far)
    return both.withColumn("known", known).filter("_kind = 1").select("_event.*", "known")


def new_since(incoming: DataFrame, known: DataFrame,
              key: tuple[str, ...] = ("device_id", "timestamp")) -> DataFrame:
    """Incoming rows whose ``key`` was not seen before (left anti join).  The
    known keys are made distinct first: a key that fills the known side shrinks
    before the shuffle."""
    return incoming.join(known.select(*key).distinct(), list(key), "left_anti")


def series_overlay(forecasts: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Long format (timestamp, value, series) of forecast, actual and
    anomaly series for one shared axis."""
    both = F.array(*[F.struct(F.col(c).alias("value"), F.lit(s).alias("series"))
                     for c, s in (("prediction", "forecast"), ("active_power", "actual"))])
    f = forecasts.select("timestamp", F.inline(both))
    x = anomalies.select("timestamp", F.col("active_power").alias("value"),
                         F.lit("anomaly").alias("series"))
    return f.unionByName(x)


def table_counts(**tables: DataFrame) -> DataFrame:
    """One row: ``<name>_count`` per table (each a partial + final count)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias(f"{name}_count"))
        out = c if out is None else _side_by_side(out, c)
    return out


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Put two one-row tables next to each other via scalar subqueries."""
    return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])
