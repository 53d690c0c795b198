"""The calibration (statistics) document: a nested JSON object with three
per-hour arrays and four summary objects.  Read with a fixed schema; a
missing or incomplete document is replaced by the default profile."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.baseline import (DEFAULT_HOURLY, DEFAULT_OVERALL, DEFAULT_SEASONS,
                                  DEFAULT_WEEKDAY_AVG, DEFAULT_WEEKEND_AVG)

HOURLY_METRICS = ["avg_active_power", "stddev_active_power", "min_active_power",
                  "max_active_power", "avg_voltage", "stddev_voltage", "min_voltage",
                  "max_voltage"]
SUMMARY_SECTIONS = {
    "winter_stats": ["winter_avg_power", "winter_stddev_power"],
    "summer_stats": ["summer_avg_power", "summer_stddev_power"],
    "other_season_stats": ["other_season_avg_power", "other_season_stddev_power"],
    "overall_stats": ["overall_avg_power", "overall_stddev_power", "overall_min_power",
                      "overall_max_power"],
}
SECTIONS = ["hourly_stats", "weekday_stats", "weekend_stats", *SUMMARY_SECTIONS]


def _struct(fields: list[str], first: tuple[str, T.DataType] | None = None) -> T.StructType:
    out = [T.StructField(first[0], first[1])] if first else []
    return T.StructType(out + [T.StructField(f, T.DoubleType()) for f in fields])


DOCUMENT_SCHEMA = T.StructType([
    T.StructField("hourly_stats", T.ArrayType(_struct(HOURLY_METRICS, ("hour_of_day", T.IntegerType())))),
    T.StructField("weekday_stats", T.ArrayType(_struct(["weekday_avg_power"], ("hour_of_day", T.IntegerType())))),
    T.StructField("weekend_stats", T.ArrayType(_struct(["weekend_avg_power"], ("hour_of_day", T.IntegerType())))),
    *[T.StructField(s, _struct(f)) for s, f in SUMMARY_SECTIONS.items()],
])


def default_sections() -> dict[str, Column]:
    """The default profile as literal columns (24 hours)."""
    hourly = F.array(*[F.struct(F.lit(h).alias("hour_of_day"),
                                *[F.lit(float(DEFAULT_HOURLY[m])).alias(m) for m in HOURLY_METRICS])
                       for h in range(24)])
    wd = F.array(*[F.struct(F.lit(h).alias("hour_of_day"),
                            F.lit(DEFAULT_WEEKDAY_AVG).alias("weekday_avg_power")) for h in range(24)])
    we = F.array(*[F.struct(F.lit(h).alias("hour_of_day"),
                            F.lit(DEFAULT_WEEKEND_AVG).alias("weekend_avg_power")) for h in range(24)])
    values = {**DEFAULT_SEASONS, **DEFAULT_OVERALL}
    out = {"hourly_stats": hourly, "weekday_stats": wd, "weekend_stats": we}
    for s, fields in SUMMARY_SECTIONS.items():
        out[s] = F.struct(*[F.lit(float(values[f])).alias(f) for f in fields])
    return out


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """One-row document, whatever its layout (one line or indented).  If the
    file is absent, unreadable, or any section is missing, the whole default
    profile is used (as the calibration consumer does)."""
    defaults = default_sections()
    try:
        parsed = spark.read.schema(DOCUMENT_SCHEMA).option("multiLine", "true").json(path)
    except AnalysisException:
        parsed = spark.createDataFrame([], DOCUMENT_SCHEMA)
    # exactly one row: the first object, or NULLs where there is none
    doc = parsed.agg(F.first(F.struct(*SECTIONS)).alias("d")).select("d.*")
    complete = F.lit(True)
    for s in SECTIONS:
        complete = complete & F.col(s).isNotNull()
    return doc.select(*[F.when(complete, F.col(s))
                        .otherwise(defaults[s].cast(DOCUMENT_SCHEMA[s].dataType)).alias(s)
                        for s in SECTIONS])


def document_rows(doc: DataFrame) -> DataFrame:
    """Flatten the document to tidy rows (section, hour_of_day, metric,
    value); whole-day sections carry hour_of_day = -1."""
    parts = []
    for section, metrics in (("hourly_stats", HOURLY_METRICS),
                             ("weekday_stats", ["weekday_avg_power"]),
                             ("weekend_stats", ["weekend_avg_power"])):
        rows = doc.select(F.explode(section).alias("r")).select("r.*")
        rows = rows.select("hour_of_day", *[F.col(m).cast("double").alias(m) for m in metrics])
        parts.append(rows.unpivot(["hour_of_day"], metrics, "metric", "value")
                     .withColumn("section", F.lit(section)))
    for section, metrics in SUMMARY_SECTIONS.items():
        rows = doc.select(*[F.col(f"{section}.{m}").cast("double").alias(m) for m in metrics])
        parts.append(rows.withColumn("hour_of_day", F.lit(-1))
                     .unpivot(["hour_of_day"], metrics, "metric", "value")
                     .withColumn("section", F.lit(section)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("section", "hour_of_day", "metric", F.round("value", 6).alias("value"))
