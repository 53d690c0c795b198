"""Cleaning queries over the raw text export."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6, to_double
from ..operators import clean, profiles
from ..schemas import RAW_COLUMNS
from ..session import scratch_path
from ..sources import exports
from ..sources import fixtures as fx
from . import oracle as o
from .catalog import register

_CLEAN_SQL = o.with_ctes(o.READINGS, o.RAW, o.TYPED, """
m AS (
  SELECT coalesce(avg(CASE WHEN isnan(Global_intensity) THEN NULL ELSE Global_intensity END), 0.0) AS m_cur,
         coalesce(avg(CASE WHEN isnan(Global_reactive_power) THEN NULL ELSE Global_reactive_power END), 0.0) AS m_rp
  FROM typed
)""") + """
SELECT event_id, "timestamp",
  CASE WHEN Global_active_power IS NULL OR isnan(Global_active_power) THEN 0.0 ELSE Global_active_power END AS active_power,
  CASE WHEN Global_reactive_power IS NULL OR isnan(Global_reactive_power) THEN round(m_rp, 6) ELSE Global_reactive_power END AS reactive_power,
  CASE WHEN Voltage IS NULL OR isnan(Voltage) THEN 230.0 ELSE Voltage END AS Voltage,
  CASE WHEN Global_intensity IS NULL OR isnan(Global_intensity) THEN round(m_cur, 6) ELSE Global_intensity END AS "current",
  CASE WHEN Sub_metering_1 IS NULL OR isnan(Sub_metering_1) THEN 0.0 ELSE Sub_metering_1 END AS Sub_metering_1,
  CASE WHEN Sub_metering_2 IS NULL OR isnan(Sub_metering_2) THEN 0.0 ELSE Sub_metering_2 END AS Sub_metering_2,
  CASE WHEN Sub_metering_3 IS NULL OR isnan(Sub_metering_3) THEN 0.0 ELSE Sub_metering_3 END AS Sub_metering_3
FROM typed CROSS JOIN m
"""

_MEASURES = ["active_power", "reactive_power", "Voltage", "current",
             "Sub_metering_1", "Sub_metering_2", "Sub_metering_3"]


@register("clean_readings", _CLEAN_SQL)
def clean_readings(spark, sf_dir):
    """Raw text export -> typed, imputed, canonical readings (D2)."""
    raw = fx.raw_readings(spark, sf_dir)
    # parsed values pass through as they are; only the filled-in means are rounded
    source = {"current": "Global_intensity", "reactive_power": "Global_reactive_power"}
    known = clean.clean(raw.withColumn("_known", F.struct(*[
        (to_double(r).isNotNull() & ~F.isnan(to_double(r))).alias(c) for c, r in source.items()])),
        keep=("event_id", "_known"))
    return known.select("event_id", "timestamp", *[
        (F.when(F.col(f"_known.{c}"), F.col(c)).otherwise(r6(c)).alias(c) if c in source else F.col(c))
        for c in _MEASURES])


@register("impute_timestamps", o.with_ctes(o.READINGS, o.RAW, o.TYPED, """
idx AS (SELECT event_id, "timestamp", row_number() OVER (ORDER BY event_id) - 1 AS row_index
        FROM typed),
anchor AS (SELECT arg_min("timestamp", row_index) AS a_ts, min(row_index) AS a_idx
           FROM idx WHERE "timestamp" IS NOT NULL)""") + """
SELECT event_id, row_index, "timestamp" IS NULL AS was_imputed,
       coalesce("timestamp",
                coalesce(a_ts, TIMESTAMP '2006-12-16 17:24:00')
                + to_minutes(CAST(row_index - coalesce(a_idx, 0) AS BIGINT))) AS "timestamp"
FROM idx CROSS JOIN anchor
""")
def impute_timestamps(spark, sf_dir):
    """Dense row index in event order; NULL timestamps (blank Date) filled
    at one minute per row from the first valid timestamp."""
    typed = clean.typed_readings(fx.raw_readings(spark, sf_dir), keep=("event_id",))
    out = clean.impute_timestamps(typed, "event_id", step_minutes=1)
    return out.select("event_id", "row_index", "was_imputed", "timestamp")


# typed rows with key columns that have NULLs, ties and values beyond 2**53
_KEYED = """
keyed AS (
  SELECT event_id, "timestamp",
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id // 10 END AS tied_key,
         1152921504606846976 + event_id AS large_key
  FROM typed)"""
_IMPUTED = """
anchor AS (SELECT arg_min("timestamp", row_index) AS a_ts, min(row_index) AS a_idx
           FROM idx WHERE "timestamp" IS NOT NULL)
SELECT event_id, row_index, "timestamp" IS NULL AS was_imputed,
       coalesce("timestamp", coalesce(a_ts, TIMESTAMP '2006-12-16 17:24:00')
                + to_minutes(CAST(row_index - coalesce(a_idx, 0) AS BIGINT))) AS "timestamp"
FROM idx CROSS JOIN anchor
"""


def _imputed_sql(order: str) -> str:
    return (o.with_ctes(o.READINGS, o.RAW, o.TYPED, _KEYED, f"""
idx AS (SELECT event_id, "timestamp", row_number() OVER (ORDER BY {order}) - 1 AS row_index
        FROM keyed)""").rstrip() + "," + _IMPUTED)


def _keyed(spark, sf_dir):
    typed = clean.typed_readings(fx.raw_readings(spark, sf_dir), keep=("event_id",))
    e = F.col("event_id")
    return typed.select("event_id", "timestamp",
                        F.when(e % 7 != 0, F.floor(e / 10)).alias("tied_key"),
                        (F.lit(1 << 60) + e).alias("large_key"))


@register("impute_null_keys", _imputed_sql("tied_key ASC NULLS LAST, event_id"))
def impute_null_keys(spark, sf_dir):
    """Imputation in the order of a key with ties and NULLs (NULLs last)."""
    out = clean.impute_timestamps(_keyed(spark, sf_dir), "tied_key", tie_breaker=("event_id",))
    return out.select("event_id", "row_index", "was_imputed", "timestamp")


@register("impute_large_keys", _imputed_sql("large_key"))
def impute_large_keys(spark, sf_dir):
    """Imputation in the order of keys above 2**53, which doubles cannot tell apart."""
    out = clean.impute_timestamps(_keyed(spark, sf_dir), "large_key")
    return out.select("event_id", "row_index", "was_imputed", "timestamp")


@register("clean_aliases", o.with_ctes(o.READINGS, o.RAW, o.TYPED) + """
SELECT "timestamp",
  CASE WHEN Global_active_power IS NULL THEN 0.0 ELSE Global_active_power END AS active_power,
  0.0 AS reactive_power,
  CASE WHEN Voltage IS NULL THEN 230.0 ELSE Voltage END AS Voltage,
  CASE WHEN Sub_metering_1 IS NULL THEN 0.0 ELSE Sub_metering_1 END AS Sub_metering_1,
  CASE WHEN Sub_metering_2 IS NULL THEN 0.0 ELSE Sub_metering_2 END AS Sub_metering_2,
  CASE WHEN Sub_metering_3 IS NULL THEN 0.0 ELSE Sub_metering_3 END AS Sub_metering_3
FROM typed
""")
def clean_aliases(spark, sf_dir):
    """Cleaning of an export with an index column, alternative column names
    and no reactive-power column (which becomes 0.0)."""
    raw = fx.raw_readings(spark, sf_dir).drop("Global_reactive_power").withColumnsRenamed({
        "event_id": "_c0", "Date": "date", "Time": "time", "Global_active_power": "globalactivepower",
        "Voltage": "voltage", "Global_intensity": "intensity", "Sub_metering_1": "submetering_1",
        "Sub_metering_2": "submetering2", "Sub_metering_3": "sub_metering3"})
    return clean.clean(raw).drop("current")


_NULL_COLS = ["timestamp"] + RAW_COLUMNS[2:]


@register("null_profile", o.with_ctes(o.READINGS, o.RAW, o.TYPED) + "SELECT count(*) AS n_rows, " + ", ".join(
    f'CAST(count_if("{c}" IS NULL{" OR isnan(" + chr(34) + c + chr(34) + ")" if c != "timestamp" else ""}) AS BIGINT) AS "null_{c}"'
    for c in _NULL_COLS) + " FROM typed")
def null_profile(spark, sf_dir):
    """NULL-or-NaN count of every typed column, one aggregate."""
    typed = clean.typed_readings(fx.raw_readings(spark, sf_dir))
    return profiles.null_counts(typed, _NULL_COLS)


# Raw exports written with three separators and column orders into one folder; some
# lines have a field too many or too few.
_EXPORT_SEPARATORS = (",", ";", "\t")


def _write_exports(spark, sf_dir) -> str:
    raw = fx.raw_readings(spark, sf_dir).withColumn("event_id", F.col("event_id").cast("string"))
    columns = raw.columns
    e = F.col("event_id").cast("long")
    path = scratch_path(spark, "exports")
    for i, sep in enumerate(_EXPORT_SEPARATORS):
        names = columns[i:] + columns[:i]
        # a date that holds the separator is quoted
        fields = [F.concat(F.lit('"'), F.col(c), F.lit('"')) if c == "Date" else F.col(c) for c in names]
        line = F.concat_ws(sep, *fields)
        line = (F.when(e % 29 == 3, F.concat(line, F.lit(f"{sep}x"))).when(e % 31 == 4, F.concat_ws(sep, *fields[:-2]))
                .otherwise(line))
        (raw.filter(e % 3 == i).select(line.alias(sep.join(names)))
         .write.option("header", "true").option("sep", "\x01").option("quote", "\x02")
         .option("escape", "\x02").csv(f"{path}/part={i}"))
    return path


@register("csv_dialects", o.with_ctes(o.READINGS, o.RAW, o.TYPED) + """
SELECT event_id, "timestamp", Global_active_power, Voltage, Sub_metering_3
FROM typed WHERE event_id % 29 <> 3 AND event_id % 31 <> 4
""")
def csv_dialects(spark, sf_dir):
    """Exports written with ',', ';' and tab into one folder, read by each file's own
    separator and column order."""
    rows, _ = exports.read_exports(spark, f"{_write_exports(spark, sf_dir)}/*")
    typed = clean.typed_readings(rows, keep=("event_id",))
    return typed.select(F.col("event_id").cast("long").alias("event_id"), "timestamp", "Global_active_power",
                        "Voltage", "Sub_metering_3")


@register("csv_rejects", o.with_ctes(o.READINGS) + """
SELECT CASE WHEN event_id % 29 = 3 THEN 'long' WHEN event_id % 31 = 4 THEN 'short' ELSE 'row' END AS outcome,
       count(*) AS n, count(DISTINCT event_id % 3) AS n_dialects
FROM readings GROUP BY 1
""")
def csv_rejects(spark, sf_dir):
    """Rows and rejects of these exports by reason: together they are all lines written."""
    rows, rejects = exports.read_exports(spark, f"{_write_exports(spark, sf_dir)}/*")
    part = F.regexp_extract("file", "part=(\\d+)", 1)
    every = (rows.select(F.lit("row").alias("outcome"), F.col("_file").alias("file"))
             .unionByName(rejects.select(F.col("reason").alias("outcome"), "file")))
    return every.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(part).alias("n_dialects"))
