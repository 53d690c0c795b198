"""Demand regression: features -> assembler -> scaler -> random forest, as
ONE saved Spark ML ``PipelineModel`` (so scoring reuses the fitted
scaler), evaluation in one aggregate, and the run records.

Training is Spark ML's distributed random forest (histogram-based split
search, partial statistics per partition).  The split is made before any
fitting (no scaler leakage) and is keyed, so reruns and re-partitioning
give the same train/test rows.

The training side is prepared once and dealt evenly over partitions of a bounded
number of rows: the forest keeps each of them in memory and reads it once a level, so
neither its size nor the number of tasks may depend on how the input was written.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import DEFAULT_VOLTAGE, fill_missing, non_nan
from ..schemas import FEATURE_COLUMNS, MODEL_INFO, TRAINING_RUNS

# Forest configurations tried in order; the first that fits wins.
MODEL_CONFIGS = [{"numTrees": 50, "maxDepth": 10},
                 {"numTrees": 30, "maxDepth": 5},
                 {"numTrees": 100, "maxDepth": 15}]
LABEL = "active_power"
# Training rows a partition may hold (the forest reads about 900 bytes for each with 50
# trees), and those that are worth a task of their own.
PARTITION_ROWS = 250_000
TASK_ROWS = 20_000
ZERO_FILLED = ["active_power", "Sub_metering_1", "Sub_metering_2", "Sub_metering_3"]
MEAN_FILLED = ["current", "reactive_power"]
NUMERIC = ["Voltage", "current", "active_power", "reactive_power",
           "Sub_metering_1", "Sub_metering_2", "Sub_metering_3"]


def prepare(readings: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Type and fill the measures (dummy 0.0 for absent ones; current and
    reactive power stay NULL for the pipeline to fill), repair the timestamp
    type, add calendar features hour / day_of_week / month."""
    df = readings
    present = {c.lower(): c for c in df.columns}
    cols = {}
    for c in NUMERIC:
        src = present.get(c.lower())
        cols[c] = F.col(src).cast("double") if src else F.lit(0.0)
    df = df.withColumns(cols)
    fills = {}
    for c in NUMERIC:
        if c in ZERO_FILLED:
            fills[c] = fill_missing(c, 0.0)
        elif c == "Voltage":
            fills[c] = fill_missing(c, DEFAULT_VOLTAGE)
        else:   # by the pipeline, with the means of the training rows
            fills[c] = non_nan(c)
    df = df.withColumns(fills)
    if ts in df.columns:
        if dict(df.dtypes)[ts] not in ("timestamp", "timestamp_ntz"):
            df = df.withColumn(ts, F.col(ts).try_cast("timestamp_ntz"))
    else:
        df = df.withColumn(ts, F.current_timestamp().cast("timestamp_ntz"))
    return df.withColumns({"hour": F.hour(ts), "day_of_week": F.dayofweek(ts),
                           "month": F.month(ts)})


def available_features(df: DataFrame, candidates: list[str] = FEATURE_COLUMNS) -> list[str]:
    feats = [c for c in candidates if c in df.columns]
    if len(feats) < 2:
        raise ValueError(f"not enough features: {feats}")
    return feats


def training_means(train_df: DataFrame) -> tuple[int, dict[str, float]]:
    """Rows of the training side, and the means that fill its missing values
    (0.0 where there is no value at all)."""
    row = train_df.agg(F.count(F.lit(1)).alias("n"),
                       *[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in MEAN_FILLED]).first()
    return row["n"], {c: row[c] for c in MEAN_FILLED}


def dealt(train_df: DataFrame, rows: int, columns: list[str]) -> DataFrame:
    """``columns`` of the training side in even partitions of at most ``PARTITION_ROWS``
    rows, and as many as the cluster has cores if there are rows enough."""
    cores = train_df.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-rows // PARTITION_ROWS), min(cores, -(-rows // TASK_ROWS)))
    return train_df.select(*columns).repartition(parts)


def build_pipeline(features: list[str], num_trees: int, max_depth: int, means: dict[str, float],
                   seed: int = 42, label: str = LABEL):
    """Fill missing measures with the training means, assemble, scale, fit:
    nothing in it is taken from the test side."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    filled = [c for c in means if c in features]
    fill = SQLTransformer(statement="SELECT *" + "".join(
        f", coalesce(nanvl(double({c}), NULL), double('{means[c]!r}')) AS {c}_filled" for c in filled)
        + " FROM __THIS__")
    assembler = VectorAssembler(inputCols=[f"{c}_filled" if c in filled else c for c in features],
                                outputCol="features_raw", handleInvalid="skip")
    # rows without a feature vector never reach the scaler or the forest
    valid = SQLTransformer(statement="SELECT * FROM __THIS__ WHERE features_raw IS NOT NULL")
    scaler = StandardScaler(inputCol="features_raw", outputCol="features",
                            withMean=True, withStd=True)
    # with each row's node kept from level to level, no row is led down from the root again;
    # the lineage is as long as the trees are deep, so it needs no checkpoints
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                               maxDepth=max_depth, seed=seed, cacheNodeIds=True, checkpointInterval=-1)
    return Pipeline(stages=[fill, assembler, valid, scaler, rf])


def split_column(key: str = "event_id", buckets: int = 5, test_buckets: int = 1):
    """'train' / 'test' by key bucket (pmod of the key): stable across
    reruns and partitionings; test share = test_buckets / buckets."""
    return F.when(F.pmod(F.col(key), F.lit(buckets)) < test_buckets, F.lit("test")) \
        .otherwise(F.lit("train"))


def split(df: DataFrame, key: str | None = "event_id", test_fraction: float = 0.2,
          ) -> tuple[DataFrame, DataFrame]:
    """Train and test side.  By key buckets where the table has the key, else
    by a hash of the row's columns: stable across reruns and partitionings (equal
    rows go to one side)."""
    if key and key in df.columns:
        side = split_column(key)
    else:
        cols = sorted(c for c, t in df.dtypes if not t.startswith("map"))
        part = F.pmod(F.xxhash64(*cols), F.lit(10_000))
        side = F.when(part < int(test_fraction * 10_000), "test").otherwise("train")
    s = df.withColumn("_split", side)
    return (s.filter(F.col("_split") == "train").drop("_split"),
            s.filter(F.col("_split") == "test").drop("_split"))


def evaluate(predictions: DataFrame, label: str = LABEL,
             prediction: str = "prediction") -> DataFrame:
    """rmse / mse / mae / r2 and the row count in ONE aggregate."""
    err = F.col(label) - F.col(prediction)
    agg = predictions.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"),
                          F.avg(F.abs(err)).alias("mae"), F.sum(err * err).alias("_sse"),
                          (F.var_pop(label) * F.count(F.lit(1))).alias("_sst"))
    return agg.select("n", F.sqrt("mse").alias("rmse"), "mse", "mae",
                      (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"))


@dataclass
class TrainingResult:
    model_timestamp: str
    model: object
    config: dict
    features: list[str]
    metrics: dict
    train_rows: int
    test_rows: int
    predictions: DataFrame
    duration_seconds: float
    errors: list[str] = field(default_factory=list)


def train(readings: DataFrame, configs: list[dict] = MODEL_CONFIGS, seed: int = 42,
          key: str | None = "event_id", predictions_path: str | None = None) -> TrainingResult:
    """Prepare, split, fit the first config that succeeds, evaluate.

    With ``predictions_path`` the test side is scored once: the predictions are
    written there and evaluated from there."""
    started = time.time()
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    if readings.isEmpty():
        raise ValueError("the dataset is empty")
    df = prepare(readings)
    feats = available_features(df)
    train_df, test_df = split(df, key)
    n_train, means = training_means(train_df)
    if not n_train:
        raise ValueError("no training rows")
    model, used, errors = None, None, []
    # on disk: the memory is for the forest's own rows
    fit_df = dealt(train_df, n_train, [*feats, LABEL]).persist(StorageLevel.DISK_ONLY)
    try:
        for cfg in configs:
            try:
                model = build_pipeline(feats, cfg["numTrees"], cfg["maxDepth"], means, seed).fit(fit_df)
                used = cfg
                break
            except Exception as e:  # noqa: BLE001 - try the next configuration
                errors.append(f"{cfg}: {e}")
    finally:
        fit_df.unpersist()
    if model is None:
        raise RuntimeError("all model configurations failed: " + "; ".join(errors))
    predictions = model.transform(test_df.hint("rebalance"))     # few row groups must not mean few tasks
    if predictions_path:
        cols = [c for c in ("event_id", "timestamp", LABEL, "prediction") if c in predictions.columns]
        predictions.select(*cols).write.mode("overwrite").parquet(predictions_path)
        predictions = readings.sparkSession.read.parquet(predictions_path)
    m = evaluate(predictions).first().asDict()
    return TrainingResult(stamp, model, used, feats,
                          {k: m[k] for k in ("rmse", "r2", "mae", "mse")}, n_train, int(m["n"]),
                          predictions, time.time() - started, errors)


def model_info_row(spark: SparkSession, r: TrainingResult) -> DataFrame:
    now = datetime.now(timezone.utc)
    return spark.createDataFrame([(r.model_timestamp, r.metrics["rmse"], r.metrics["r2"],
                                   r.metrics["mae"], r.metrics["mse"], None, None, r.features,
                                   r.train_rows, now)], MODEL_INFO)


def training_run_row(spark: SparkSession, model_timestamp: str, status: str,
                     duration: float, config: dict | None, error: str | None) -> DataFrame:
    now = datetime.now(timezone.utc)
    return spark.createDataFrame([(model_timestamp, status, float(duration), config, error, now)],
                                 TRAINING_RUNS)


def metrics_line(spark: SparkSession, r: TrainingResult) -> DataFrame:
    return spark.createDataFrame([{
        "model_timestamp": r.model_timestamp, **{k: float(v) for k, v in r.metrics.items()},
        "train_samples": r.train_rows, "test_samples": r.test_rows,
        "features": r.features, "config": r.config,
        "timestamp": datetime.now(timezone.utc).isoformat()}])


def feature_vectors(model, prepared: DataFrame, features: list[str]) -> DataFrame:
    """``prepared`` rows that have a feature vector, plus ``scaled_<feature>``: what the
    pipeline's stages before the forest make of them."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    v = PipelineModel(model.stages[:-1]).transform(prepared).withColumn("_v", vector_to_array("features"))
    return v.select(*prepared.columns, *[F.col("_v")[i].alias(f"scaled_{c}") for i, c in enumerate(features)])


def score(model, requests: DataFrame) -> DataFrame:
    """Apply the saved pipeline to request rows that already carry the feature
    columns; only the prediction is added."""
    return model.transform(requests).select(*requests.columns, "prediction")
