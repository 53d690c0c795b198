"""Regression, sampling and split queries.

The forest is trained once per (session, data directory): the fitted
pipeline is saved (K15) and its run records are appended to result tables
under the checkpoint directory (K8-K11); later queries load the saved
model (S9) instead of refitting.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions.columns import r6
from .. import jobs
from ..operators import forecast, readmodels, sampling
from ..schemas import FEATURE_COLUMNS
from ..session import scratch_path
from ..sinks import tables
from ..sources import fixtures as fx
from ..sources.readers import load_model
from . import oracle as o
from .catalog import register

_TRAINED: dict[tuple[str, str], dict] = {}


def trained(spark, sf_dir: str) -> dict:
    """Train once per (application, data directory) with ``jobs.train``."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _TRAINED:
        _TRAINED[key] = jobs.train(spark, fx.readings(spark, sf_dir),
                                   scratch_path(spark, "model-registry"))
    return _TRAINED[key]


_SPLIT = """
sides AS (SELECT *, event_id % 5 < 1 AS is_test FROM readings)"""
_FEATURES = ",".join(FEATURE_COLUMNS)


@register("regression_metrics", o.with_ctes(o.READINGS, _SPLIT) + """
SELECT CAST(count_if(NOT is_test) AS BIGINT) AS train_samples,
       CAST(count_if(is_test) AS BIGINT) AS test_samples,
       50 AS num_trees, 10 AS max_depth, 8 AS n_features, true AS metrics_consistent
FROM sides
""")
def regression_metrics(spark, sf_dir):
    """Random-forest demand model: sample counts, the configuration that
    fitted, and whether the recorded metrics agree with each other and with the
    held-out predictions they were taken from (their values are seeded, see
    ``baseline_metrics`` for the formulas)."""
    t = trained(spark, sf_dir)
    r = t["result"]
    p = spark.read.parquet(t["forecasts"]).filter("source = 'holdout'")
    err = F.col("active_power") - F.col("prediction")
    near = lambda a, b: F.abs(a - F.lit(b)) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(F.lit(b)))
    checked = p.agg((near(F.sqrt(F.avg(err * err)), r.metrics["rmse"])
                     & near(F.avg(err * err), r.metrics["mse"])
                     & near(F.avg(F.abs(err)), r.metrics["mae"])
                     & near(F.lit(1.0) - F.sum(err * err) / (F.var_pop("active_power") * F.count(F.lit(1))),
                            r.metrics["r2"])).alias("metrics_consistent"))
    return checked.select(
        F.lit(r.train_rows).cast("long").alias("train_samples"),
        F.lit(r.test_rows).cast("long").alias("test_samples"),
        F.lit(r.config["numTrees"]).alias("num_trees"), F.lit(r.config["maxDepth"]).alias("max_depth"),
        F.lit(len(r.features)).alias("n_features"), "metrics_consistent")


@register("forecast_table", o.with_ctes(o.READINGS, _SPLIT) + """
SELECT event_id, "timestamp", active_power, true AS has_prediction, 'holdout' AS source
FROM sides WHERE is_test ORDER BY "timestamp" DESC, event_id DESC LIMIT 1000
""")
def forecast_table(spark, sf_dir):
    """The 1,000 newest held-out rows of the forecasts table written by
    training, as the dashboard reads them."""
    f = spark.read.parquet(trained(spark, sf_dir)["forecasts"]).filter("source = 'holdout'")
    has = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return readmodels.newest(f.select("event_id", "timestamp", "active_power",
                                      has.alias("has_prediction"), "source"), 1000)


@register("training_log", o.with_ctes(o.READINGS, _SPLIT) + f"""
SELECT 'SUCCESS' AS status, count(*) AS num_training_samples,
       '{_FEATURES}' AS feature_columns, 50 AS num_trees, 10 AS max_depth
FROM sides WHERE NOT is_test
""")
def training_log(spark, sf_dir):
    """The newest model-info row of each model joined to its newest run."""
    t = trained(spark, sf_dir)
    info = readmodels.latest(spark.read.parquet(t["model_info"]), "created_at", by=("model_timestamp",))
    runs = readmodels.latest(spark.read.parquet(t["training_runs"]), "created_at", by=("model_timestamp",))
    return info.join(runs.select("model_timestamp", "status", "config"), "model_timestamp", "left").select(
        "status", "num_training_samples", F.array_join("feature_columns", ",").alias("feature_columns"),
        F.col("config")["numTrees"].alias("num_trees"), F.col("config")["maxDepth"].alias("max_depth"))


@register("score_requests", o.with_ctes(o.READINGS, o.REQUESTS) + """
SELECT event_id, CAST(NULL AS DOUBLE) AS active_power, true AS has_prediction, 'request' AS source
FROM requests WHERE Voltage BETWEEN 0 AND 500 AND "current" BETWEEN 0 AND 100 AND "hour" <= 23
  AND Sub_metering_1 >= 0 AND Sub_metering_2 >= 0 AND Sub_metering_3 >= 0
""")
def score_requests(spark, sf_dir):
    """Validate the request table, score the valid rows with the saved
    pipeline and write them as 'request' forecasts (no actual value) to a table
    of their own; no other query reads it."""
    t = trained(spark, sf_dir)
    # scoring costs far more than the shuffle: it must not depend on how the input was written
    v = readmodels.validate(fx.requests(spark, sf_dir)).filter("is_valid").hint("rebalance")
    scored = forecast.score(load_model(t["model_path"]), v).withColumn("timestamp", F.localtimestamp())
    path = f"{t['requests']}/{uuid.uuid4().hex[:12]}"
    tables.append_forecasts(scored, path, "request")
    has = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return tables.read_result(spark, path, "forecasts").select(
        "event_id", "active_power", has.alias("has_prediction"), "source")


@register("baseline_metrics", o.with_ctes(o.READINGS, o.CAL, """
pairs AS (SELECT active_power AS y, 2.0 + 0.5 * hour_of_day AS p FROM cal)""") + """
SELECT count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg((y - p) * (y - p)), 6) AS mse,
       round(avg(abs(y - p)), 6) AS mae, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
FROM pairs
""")
def baseline_metrics(spark, sf_dir):
    """The metric formulas over a prediction that every engine computes alike."""
    r = fx.readings(spark, sf_dir).withColumn("prediction", F.lit(2.0) + 0.5 * F.hour("timestamp"))
    return forecast.evaluate(r).select("n", *[r6(c).alias(c) for c in ("rmse", "mse", "mae", "r2")])


@register("train_test_split", o.with_ctes(o.READINGS) + """
SELECT CASE WHEN event_id % 5 < 1 THEN 'test' ELSE 'train' END AS split,
       count(*) AS n_rows, round(avg(active_power), 6) AS avg_active_power
FROM readings GROUP BY 1
""")
def train_test_split(spark, sf_dir):
    """Keyed 80/20 split used for training: size and mean label per side
    (every row lands in exactly one side)."""
    r = fx.readings(spark, sf_dir)
    return (r.groupBy(forecast.split_column("event_id").alias("split"))
            .agg(F.count(F.lit(1)).alias("n_rows"), r6(F.avg("active_power")).alias("avg_active_power")))


@register("sample_readings", o.with_ctes(o.READINGS) + """
SELECT * FROM readings
WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':42'), 1, 8) AS BIGINT)
      < (SELECT least(1.0, 5.0 / greatest(count(*) * 0.001, 1e-12)) FROM readings) * 4294967296
""")
def sample_readings(spark, sf_dir, target_mb: float = 5.0, row_mb: float = 0.001,
                    seed: int = 42):
    """Sample sized for a target volume: fraction = target_mb / (rows *
    row_mb), clamped to 1.  A row is drawn by a seeded hash of its key, so the
    sample does not depend on partitioning."""
    r = fx.readings(spark, sf_dir)
    fraction = r.agg(F.least(F.lit(1.0), F.lit(target_mb) / F.greatest(
        F.count(F.lit(1)) * F.lit(row_mb), F.lit(1e-12)))).scalar()
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("event_id").cast("string"),
                                                F.lit(str(seed))).cast("binary")), 1, 8), 16, 10)
    return r.filter(draw.cast("long") < fraction * F.lit(float(1 << 32)))


@register("sample_exact", o.with_ctes(o.READINGS) + """
SELECT event_id, device_id FROM readings
ORDER BY md5('7:' || CAST(event_id AS VARCHAR)) LIMIT (SELECT 3 * count(*) // 10 FROM readings)
""")
def sample_exact(spark, sf_dir):
    """A sample of exactly three tenths of the readings."""
    r = fx.readings(spark, sf_dir).select("event_id", "device_id")
    return sampling.exact_sample(r, 3 * r.count() // 10, "event_id", seed=7)


_SCALED = [f"round(CASE WHEN coalesce(s_{c}, 0) = 0 THEN 0 ELSE (t_{c} - m_{c}) / s_{c} END, 6) AS scaled_{c.lower()}"
           for c in FEATURE_COLUMNS]


@register("feature_vectors", o.with_ctes(o.READINGS, _SPLIT, """
calendar AS (SELECT *, hour("timestamp") AS "hour", isodow("timestamp") % 7 + 1 AS day_of_week,
                    month("timestamp") AS "month" FROM sides WHERE NOT is_test)""", f"""
typed AS (SELECT event_id, {", ".join(f'CAST("{c}" AS DOUBLE) AS t_{c}' for c in FEATURE_COLUMNS)} FROM calendar)""", f"""
fitted AS (SELECT {", ".join(f"avg(t_{c}) AS m_{c}, stddev_samp(t_{c}) AS s_{c}" for c in FEATURE_COLUMNS)} FROM typed)
""") + f"""
SELECT event_id, {", ".join(_SCALED)} FROM typed, fitted
""")
def feature_vectors(spark, sf_dir):
    """The assembled and standardised features of every training row, as the saved
    pipeline gives them to the forest."""
    t = trained(spark, sf_dir)
    train_side, _ = forecast.split(forecast.prepare(fx.readings(spark, sf_dir)))
    v = forecast.feature_vectors(load_model(t["model_path"]), train_side, t["result"].features)
    return v.select("event_id", *[r6(f"scaled_{c}").alias(f"scaled_{c.lower()}") for c in FEATURE_COLUMNS])
