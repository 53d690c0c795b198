"""3-sigma outlier detection per device (statistics -> lookup join ->
bounds -> flag -> keep outliers or injected rows).

The same DataFrame -> DataFrame function is used by the batch queries and by
each micro-batch of the stream.  Statistics are a partial + final hash
aggregate (a hot device is combined map-side, never gathered in one task).  The
join is left to adaptive execution, unless the statistics are to be kept (``keep``):
then they are written once and measured, and broadcast if they are small enough, so
the readings are not shuffled by device.  A NaN value counts as missing.

Bound: in a group of n readings an in-sample z-score cannot exceed
(n-1)/sqrt(n), so with k = 3 groups of n <= 10 never produce an outlier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import non_nan
from ..plans.joins import kept_lookup, lookup_join, measured_join


def group_stats(readings: DataFrame, keys=("device_id",), value: str = "active_power",
                min_count: int = 3) -> DataFrame:
    """mean / sample stddev / count of the values that are neither NULL nor NaN
    per group, groups below ``min_count`` dropped (HAVING)."""
    present = non_nan(value)
    return (readings.groupBy(*keys)
            .agg(F.avg(present).alias("mean"),
                 F.stddev_samp(present).alias("stddev"),
                 F.count(present).alias("count"))
            .filter(F.col("count") >= min_count))


def sigma_bounds(mean: Column, stddev: Column, k: float) -> tuple[Column, Column]:
    return mean - F.lit(k) * stddev, mean + F.lit(k) * stddev


def outlier_flag(value: Column, lower: Column, upper: Column) -> Column:
    """Strictly outside the bounds.  NULL value or NULL bounds -> NULL."""
    return (value < lower) | (value > upper)


def score(readings: DataFrame, stats: DataFrame, keys=("device_id",),
          value: str = "active_power", k: float = 3.0, how: str = "inner", kept: bool = False) -> DataFrame:
    """Attach statistics, bounds and the outlier flag to every reading.  ``kept``:
    the statistics are a written table, whose size is measured."""
    join = measured_join if kept else lookup_join
    enriched = join(readings, stats.drop("count"), list(keys), how)
    lower, upper = sigma_bounds(F.col("mean"), F.col("stddev"), k)
    return (enriched
            .withColumn("lower_bound", lower)
            .withColumn("upper_bound", upper)
            .withColumn("is_anomaly", outlier_flag(non_nan(value), F.col("lower_bound"),
                                                   F.col("upper_bound"))))


def detect(readings: DataFrame, keys=("device_id",), value: str = "active_power",
           k: float = 3.0, min_count: int = 3,
           injected: str | None = "is_injected_anomaly",
           with_detection_time: bool = False, stats: DataFrame | None = None,
           keep: bool = False) -> DataFrame:
    """Rows that are statistical outliers of their group, or were injected
    as anomalies.  Groups below ``min_count`` are not scored (inner join).
    ``stats``: given statistics (say, merged over many days) instead of those of
    the readings; with ``keep`` they are a written table.  ``keep`` runs a job, the
    aggregation, while the query is built."""
    if stats is None:
        stats = group_stats(readings, keys, value, min_count)
        stats = kept_lookup(stats, "device-stats") if keep else stats
    scored = score(readings, stats, keys, value, k, kept=keep)
    keep = F.col("is_anomaly")
    if injected and injected in readings.columns:
        keep = keep | F.col(injected)
    out = scored.filter(keep)
    if with_detection_time:
        out = out.withColumn("detection_time", F.current_timestamp())
    return out


def quality(readings: DataFrame, keys=("device_id",), value: str = "active_power",
            k: float = 3.0, min_count: int = 3,
            injected: str = "is_injected_anomaly") -> DataFrame:
    """Precision / recall of the statistical flag against the injected label,
    over every reading (unscored groups count as not flagged)."""
    stats = group_stats(readings, keys, value, min_count)
    scored = score(readings, stats, keys, value, k, how="left")
    flagged = F.coalesce(F.col("is_anomaly"), F.lit(False))
    label = F.coalesce(F.col(injected), F.lit(False))
    agg = scored.agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.count_if(flagged).alias("n_flagged"),
        F.count_if(label).alias("n_injected"),
        F.count_if(flagged & label).alias("true_positives"),
        F.count_if(flagged & ~label).alias("false_positives"),
        F.count_if(~flagged & label).alias("false_negatives"),
    )
    return agg.select(
        "*",
        F.round(F.try_divide(F.col("true_positives"), F.col("n_flagged")), 6).alias("precision"),
        F.round(F.try_divide(F.col("true_positives"), F.col("n_injected")), 6).alias("recall"),
    )
