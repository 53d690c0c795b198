"""Mergeable statistics per device, kept as a table of daily moments.

A moments table holds one row a (device, day) of each batch: the number n of values
that are neither NULL nor NaN, their mean, and m2, the sum of squared deviations
from it.  Moments of disjoint parts merge exactly (the parallel variance formula):

    n = sum n_i,  mean = sum n_i mean_i / n,  m2 = sum (m2_i + n_i (mean_i - mean)^2)

so statistics over any range of days come from a few rows a device and never from the
readings again, and new readings only cost their own aggregation.  A batch overwrites
its own ``batch`` partition: a batch that is replayed after a failure, or a day that is
loaded again, replaces its rows instead of counting twice.  Days may arrive late, and
several batches may hold readings of the same day.

All steps are partial and final aggregates; a hot device is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import non_nan


def daily_moments(readings: DataFrame, keys=("device_id",), value: str = "active_power",
                  ts: str = "timestamp") -> DataFrame:
    """(keys, day, n, mean, m2) of the readings; groups without a value have no row."""
    present = non_nan(value)
    return (readings.groupBy(*keys, F.to_date(ts).alias("day"))
            .agg(F.count(present).alias("n"), F.avg(present).alias("mean"),
                 (F.var_pop(present) * F.count(present)).alias("m2"))
            .filter("n > 0"))


def add_batch(moments: DataFrame, path: str, batch: int | Column) -> None:
    """Write the moments of one batch (or of several, by a column) to the table at
    ``path``, replacing what these batches wrote before."""
    (moments.withColumn("batch", batch if isinstance(batch, Column) else F.lit(batch).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(path))


def read_moments(spark: SparkSession, path: str, keys: str = "device_id string") -> DataFrame:
    """The moments table; no rows where nothing has been written yet."""
    schema = f"{keys}, day date, n long, mean double, m2 double, batch long"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def merge_moments(moments: DataFrame, by: tuple[str, ...] = ("device_id",)) -> DataFrame:
    """One row of moments for each ``by``; rows without a device (null), which no
    reading can be judged by, are left out."""
    total = moments.groupBy(*by).agg(F.sum("n").alias("n"),
                                     (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    shift = F.col("mean") - F.col("_mean")
    return (moments.withColumnRenamed("n", "_n").join(total, list(by))
            .groupBy(*by).agg(F.max("n").alias("n"), F.max("_mean").alias("mean"),
                              F.sum(F.col("m2") + F.col("_n") * shift * shift).alias("m2")))


def statistics(moments: DataFrame, by: tuple[str, ...] = ("device_id",), min_count: int = 3) -> DataFrame:
    """mean, sample stddev and count per group, as ``anomaly.group_stats`` gives them
    over all readings; groups below ``min_count`` dropped."""
    return (merge_moments(moments, by).filter(F.col("n") >= min_count)
            .select(*by, "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev"),
                    F.col("n").alias("count")))


def compact(spark: SparkSession, path: str, target: str, keys: str = "device_id string") -> None:
    """The table with one row a (device, day), written to another place as batch -1."""
    by = tuple(k.split()[0] for k in keys.split(",")) + ("day",)
    add_batch(merge_moments(read_moments(spark, path, keys), by), target, -1)
