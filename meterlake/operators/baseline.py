"""Calibrated expected load and the simulator's physical rules, as column
operators over a readings table.

Expected power = hourly average x weekend factor(hour) x seasonal factor,
all calibrated from one aggregate pass over a reference readings table.
The calibration is at most 26 rows (24 hours, a NULL hour, one total row).  It
becomes one row, an array by hour with the seasonal factors beside it, and is one
scalar subquery: the readings are projected, not joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (OTHER_MONTHS, SUMMER_MONTHS, WEEKDAYS, WEEKEND_DAYS,
                                 WINTER_MONTHS, col, device_number, half_up)

# The default calibration used when a profile is absent.
DEFAULT_HOURLY = {"avg_active_power": 2.0, "stddev_active_power": 0.5,
                  "min_active_power": 0.5, "max_active_power": 5.0,
                  "avg_voltage": 230.0, "stddev_voltage": 5.0,
                  "min_voltage": 220.0, "max_voltage": 240.0}
DEFAULT_WEEKDAY_AVG = 2.0
DEFAULT_WEEKEND_AVG = 2.5
DEFAULT_SEASONS = {"winter_avg_power": 2.5, "winter_stddev_power": 0.6,
                   "summer_avg_power": 2.3, "summer_stddev_power": 0.5,
                   "other_season_avg_power": 2.0, "other_season_stddev_power": 0.4}
DEFAULT_OVERALL = {"overall_avg_power": 2.2, "overall_stddev_power": 0.5,
                   "overall_min_power": 0.2, "overall_max_power": 6.0}
DEFAULT_WEEKEND_FACTOR = 1.3
DEFAULT_SEASON_FACTORS = {"winter": 1.3, "summer": 1.2, "other": 1.0}

# Device classes by meter number, physical clamps.
LARGE_BELOW = 20
SMALL_ABOVE = 80
POWER_FLOOR = 0.01
VOLTAGE_RANGE_NORMAL = (215, 245)
VOLTAGE_RANGE_ANOMALY = (180, 260)


def _truthy(c: Column) -> Column:
    """Python truthiness of a number: present and non-zero."""
    return c.isNotNull() & (c != 0)


def calibration(reference: DataFrame, power: str = "active_power",
                ts: str = "timestamp") -> DataFrame:
    """Calibration table from one scan of ``reference``: one row per hour of
    day (``is_total`` false) plus one total row, with the hourly, weekday,
    weekend, seasonal and overall average load.

    A ROLLUP over hour_of_day bounds the result to at most 26 rows (24 hours,
    a NULL hour, the total).
    """
    d = reference.select(F.col(power).alias("p"), F.hour(ts).alias("hour_of_day"),
                         F.dayofweek(ts).alias("dow"), F.month(ts).alias("m"))
    p, dow, m = F.col("p"), F.col("dow"), F.col("m")
    weekday, weekend = dow.between(WEEKDAYS[0], WEEKDAYS[-1]), dow.isin(*WEEKEND_DAYS)
    agg = d.rollup("hour_of_day").agg(
        F.grouping("hour_of_day").cast("boolean").alias("is_total"),
        F.avg(p).alias("avg_active_power"),
        F.count_if(weekday).alias("weekday_n"), F.avg(F.when(weekday, p)).alias("weekday_avg_power"),
        F.count_if(weekend).alias("weekend_n"), F.avg(F.when(weekend, p)).alias("weekend_avg_power"),
        F.avg(F.when(m.isin(*WINTER_MONTHS), p)).alias("winter_avg_power"),
        F.avg(F.when(m.isin(*SUMMER_MONTHS), p)).alias("summer_avg_power"),
        F.avg(F.when(m.isin(*OTHER_MONTHS), p)).alias("other_season_avg_power"))
    return agg


def weekend_ratio(weekday_avg: Column, weekend_avg: Column) -> Column:
    ok = _truthy(weekend_avg) & _truthy(weekday_avg) & (weekday_avg > 0)
    return F.when(ok, weekend_avg / weekday_avg).otherwise(F.lit(DEFAULT_WEEKEND_FACTOR))


def _factor_struct() -> Column:
    """The factor of each season from the total row: season avg / overall avg when all
    three season averages are truthy and overall avg > 0, else the defaults."""
    w, s, o, a = (F.col(c) for c in ("winter_avg_power", "summer_avg_power",
                                     "other_season_avg_power", "avg_active_power"))
    ok = _truthy(w) & _truthy(s) & _truthy(o) & a.isNotNull() & (a > 0)
    return F.struct(
        F.when(ok, w / a).otherwise(DEFAULT_SEASON_FACTORS["winter"]).alias("winter"),
        F.when(ok, s / a).otherwise(DEFAULT_SEASON_FACTORS["summer"]).alias("summer"),
        F.when(ok, o / a).otherwise(DEFAULT_SEASON_FACTORS["other"]).alias("other"))


def _profile(cal: DataFrame) -> Column:
    """The calibration as one scalar subquery: ``hours``, an array of (base, ratio) by
    hour of day with NULL for an hour without readings, and the seasonal ``factors``."""
    ratio = weekend_ratio(F.when(F.col("weekday_n") > 0, F.col("weekday_avg_power")),
                          F.when(F.col("weekend_n") > 0, F.col("weekend_avg_power")))
    entry = F.struct(F.col("hour_of_day"), F.struct(F.col("avg_active_power").alias("base"), ratio.alias("ratio")))
    an_hour = ~F.col("is_total") & F.col("hour_of_day").isNotNull()
    one = cal.agg(F.map_from_entries(F.collect_list(F.when(an_hour, entry))).alias("m"),
                  F.max(F.when(F.col("is_total"), _factor_struct())).alias("factors"))
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.try_element_at("m", h))
    return one.select(F.struct(hours.alias("hours"), "factors")).scalar()


def expected_power(readings: DataFrame, reference: DataFrame | None = None,
                   ts: str = "timestamp") -> DataFrame:
    """Attach hour_of_day / day_of_week / month, base_power, weekend_factor,
    seasonal_factor and expected_power to every reading.  ``reference``
    (default: the readings themselves) calibrates the profile."""
    cal = calibration(reference if reference is not None else readings)
    profile = _profile(cal)
    factors = profile.getField("factors")
    season = {name: F.coalesce(factors.getField(name), F.lit(DEFAULT_SEASON_FACTORS[name]))
              for name in ("winter", "summer", "other")}
    joined = readings.withColumns({"hour_of_day": F.hour(ts), "day_of_week": F.dayofweek(ts), "month": F.month(ts)})
    joined = joined.withColumn("_hour", F.get(profile.getField("hours"), F.col("hour_of_day")))
    m = F.col("month")
    seasonal = (F.when(m.isin(*WINTER_MONTHS), season["winter"])
                .when(m.isin(*SUMMER_MONTHS), season["summer"])
                .otherwise(season["other"]))
    weekend = F.col("day_of_week").isin(*WEEKEND_DAYS)
    out = joined.withColumns({
        "base_power": F.coalesce(F.col("_hour.base"), F.lit(DEFAULT_HOURLY["avg_active_power"])),
        "weekend_factor": F.when(weekend, F.coalesce(F.col("_hour.ratio"),
                                                     F.lit(DEFAULT_WEEKEND_FACTOR)))
        .otherwise(F.lit(1.0)),
        "seasonal_factor": seasonal,
    })
    out = out.withColumn("expected_power", F.col("base_power") * F.col("weekend_factor")
                         * F.col("seasonal_factor"))
    return out.drop("_hour")


def device_class(device_id: str | Column) -> Column:
    n = device_number(device_id)
    return (F.when(n < LARGE_BELOW, F.lit("large")).when(n > SMALL_ABOVE, F.lit("small"))
            .when(n.isNotNull(), F.lit("average")))


def clamp(c: Column, lo, hi) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def clamped(readings: DataFrame, power: str = "active_power", voltage: str = "voltage",
            injected: str = "is_injected_anomaly") -> DataFrame:
    """Physical limits: power floor 0.01; voltage within [215, 245], or
    [180, 260] for anomalous readings; current = power / voltage (0 when
    voltage is not positive), 3 decimals."""
    p = F.greatest(col(power), F.lit(POWER_FLOOR))
    v = F.when(F.coalesce(col(injected), F.lit(False)), clamp(col(voltage), *VOLTAGE_RANGE_ANOMALY)) \
        .otherwise(clamp(col(voltage), *VOLTAGE_RANGE_NORMAL))
    return readings.withColumns({"active_power_clamped": p, "voltage_clamped": v}).withColumn(
        "current_derived",
        half_up(F.when(F.col("voltage_clamped") > 0,
                       F.col("active_power_clamped") / F.col("voltage_clamped"))
                .otherwise(F.lit(0.0)), 3))
