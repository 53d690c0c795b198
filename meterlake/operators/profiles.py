"""Load profiles and table statistics.

Every profile is a partial + final hash aggregate over a handful of groups
(hours, seasons), so the shuffle carries a few rows per map task whatever
the input size.  ``profile_pass`` computes *all* sections of the statistics
document in one scan with a ROLLUP (per-hour rows plus one grand-total row)
and conditional aggregates, instead of one job per section.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (OTHER_MONTHS, SUMMER_MONTHS, WEEKDAYS, WEEKEND_DAYS,
                                 WINTER_MONTHS, is_missing, non_nan, r6, season_of)

POWER = "active_power"
VOLTAGE = "voltage"  # resolved case-insensitively, also matches "Voltage"


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns({"hour_of_day": F.hour(ts), "day_of_week": F.dayofweek(ts),
                           "month": F.month(ts)})


def _identity(c):
    return c


def _hourly_measures(power: str = POWER, voltage: str = VOLTAGE, rnd=r6):
    return [
        rnd(F.avg(power)).alias("avg_active_power"),
        rnd(F.stddev_samp(power)).alias("stddev_active_power"),
        F.min(power).alias("min_active_power"),
        F.max(power).alias("max_active_power"),
        rnd(F.avg(voltage)).alias("avg_voltage"),
        rnd(F.stddev_samp(voltage)).alias("stddev_voltage"),
        F.min(voltage).alias("min_voltage"),
        F.max(voltage).alias("max_voltage"),
    ]


def hourly_profile(readings: DataFrame, power: str = POWER, voltage: str = VOLTAGE) -> DataFrame:
    """avg / stddev / min / max of power and voltage per hour of day."""
    return (with_calendar(readings).groupBy("hour_of_day")
            .agg(*_hourly_measures(power, voltage)).orderBy("hour_of_day"))


def weekday_profile(readings: DataFrame, power: str = POWER) -> DataFrame:
    d = with_calendar(readings)
    return (d.filter(F.col("day_of_week").between(WEEKDAYS[0], WEEKDAYS[-1]))
            .groupBy("hour_of_day").agg(r6(F.avg(power)).alias("weekday_avg_power"))
            .orderBy("hour_of_day"))


def weekend_profile(readings: DataFrame, power: str = POWER) -> DataFrame:
    d = with_calendar(readings)
    return (d.filter(F.col("day_of_week").isin(*WEEKEND_DAYS))
            .groupBy("hour_of_day").agg(r6(F.avg(power)).alias("weekend_avg_power"))
            .orderBy("hour_of_day"))


def season_profile(readings: DataFrame, power: str = POWER) -> DataFrame:
    """One row per season (winter / summer / other); a season without readings
    has n = 0 and NULLs."""
    by = readings.select(season_of(F.month("timestamp")).alias("season"), F.col(power).alias("p"))
    row = []
    for name in ("winter", "summer", "other"):
        p = F.when(F.col("season") == name, F.col("p"))
        row.append(F.struct(F.lit(name).alias("season"), F.count(p).alias("n"),
                            r6(F.avg(p)).alias("avg_power"), r6(F.stddev_samp(p)).alias("stddev_power")))
    return by.agg(F.array(*row).alias("rows")).select(F.inline("rows"))


def overall_profile(readings: DataFrame, power: str = POWER) -> DataFrame:
    return readings.agg(r6(F.avg(power)).alias("overall_avg_power"),
                        r6(F.stddev_samp(power)).alias("overall_stddev_power"),
                        F.min(power).alias("overall_min_power"),
                        F.max(power).alias("overall_max_power"))


def hourly_load(readings: DataFrame, power: str = POWER, voltage: str = VOLTAGE) -> DataFrame:
    """Hourly sum of positive load and average voltage (the benchmark query)."""
    return (readings.filter(F.col(power) > 0)
            .groupBy(F.hour("timestamp").alias("hour"))
            .agg(r6(F.sum(power)).alias("sum_active_power"),
                 r6(F.avg(voltage)).alias("avg_voltage")))


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """count / mean / stddev / min / max of each column as a tidy table
    (one wide global aggregate, then ``stack`` the single row)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`"
        for c in columns)
    tidy = wide.selectExpr(
        f"stack({len(columns)}, {parts}) AS (column_name, count, mean, stddev, min, max)")
    return tidy.select("column_name", "count", r6("mean").alias("mean"),
                       r6("stddev").alias("stddev"), r6("min").alias("min"),
                       r6("max").alias("max"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL-or-NaN count of every column in one aggregate (one job)."""
    out = []
    for c in columns:
        dt = dict(df.dtypes)[c]
        miss = is_missing(c) if dt in ("double", "float") else F.col(c).isNull()
        out.append(F.count_if(miss).alias(f"null_{c}"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *out)


def profile_pass(readings: DataFrame, power: str = POWER, voltage: str = VOLTAGE,
                 rounded: bool = True) -> DataFrame:
    """All profile sections from one scan.

    ``rollup(hour_of_day)`` yields one row per hour (``is_total`` false)
    and one grand-total row (``is_total`` true); conditional aggregates give
    the weekday / weekend / season figures.  Output: at most 26 rows.
    ``rounded=False`` keeps full precision (used for calibration).
    """
    rnd = r6 if rounded else _identity
    d = with_calendar(readings)
    dow, month, p = F.col("day_of_week"), F.col("month"), F.col(power)
    weekday = dow.between(WEEKDAYS[0], WEEKDAYS[-1])
    weekend = dow.isin(*WEEKEND_DAYS)

    def when(cond):
        return F.when(cond, p)

    return (d.rollup("hour_of_day").agg(
        F.grouping("hour_of_day").cast("boolean").alias("is_total"),
        *_hourly_measures(power, voltage, rnd),
        F.count_if(weekday).alias("weekday_n"),
        rnd(F.avg(when(weekday))).alias("weekday_avg_power"),
        F.count_if(weekend).alias("weekend_n"),
        rnd(F.avg(when(weekend))).alias("weekend_avg_power"),
        rnd(F.avg(when(month.isin(*WINTER_MONTHS)))).alias("winter_avg_power"),
        rnd(F.stddev_samp(when(month.isin(*WINTER_MONTHS)))).alias("winter_stddev_power"),
        rnd(F.avg(when(month.isin(*SUMMER_MONTHS)))).alias("summer_avg_power"),
        rnd(F.stddev_samp(when(month.isin(*SUMMER_MONTHS)))).alias("summer_stddev_power"),
        rnd(F.avg(when(month.isin(*OTHER_MONTHS)))).alias("other_season_avg_power"),
        rnd(F.stddev_samp(when(month.isin(*OTHER_MONTHS)))).alias("other_season_stddev_power"),
    ))


def statistics_document(readings: DataFrame, power: str = POWER,
                        voltage: str = VOLTAGE) -> DataFrame:
    """The calibration document as ONE row of nested columns:
    ``hourly_stats``/``weekday_stats``/``weekend_stats`` arrays ordered by
    hour, ``winter/summer/other_season/overall_stats`` structs.  Built from
    the ≤26-row output of :func:`profile_pass`."""
    prof = profile_pass(readings, power, voltage)
    hour_rows = ~F.col("is_total")
    hourly = F.struct("hour_of_day", "avg_active_power", "stddev_active_power",
                      "min_active_power", "max_active_power", "avg_voltage",
                      "stddev_voltage", "min_voltage", "max_voltage")
    wd = F.struct("hour_of_day", "weekday_avg_power")
    we = F.struct("hour_of_day", "weekend_avg_power")

    def sorted_list(cond, s):
        return F.array_sort(F.collect_list(F.when(cond, s)))

    def total(c):
        return F.max(F.when(F.col("is_total"), F.col(c)))

    return prof.agg(
        sorted_list(hour_rows, hourly).alias("hourly_stats"),
        sorted_list(hour_rows & (F.col("weekday_n") > 0), wd).alias("weekday_stats"),
        sorted_list(hour_rows & (F.col("weekend_n") > 0), we).alias("weekend_stats"),
        F.struct(total("winter_avg_power").alias("winter_avg_power"),
                 total("winter_stddev_power").alias("winter_stddev_power")).alias("winter_stats"),
        F.struct(total("summer_avg_power").alias("summer_avg_power"),
                 total("summer_stddev_power").alias("summer_stddev_power")).alias("summer_stats"),
        F.struct(total("other_season_avg_power").alias("other_season_avg_power"),
                 total("other_season_stddev_power").alias("other_season_stddev_power"))
        .alias("other_season_stats"),
        F.struct(total("avg_active_power").alias("overall_avg_power"),
                 total("stddev_active_power").alias("overall_stddev_power"),
                 total("min_active_power").alias("overall_min_power"),
                 total("max_active_power").alias("overall_max_power")).alias("overall_stats"),
    )
