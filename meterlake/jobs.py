"""End-to-end jobs (what a deployment runs), built from the operators:

* ``ingest``  raw CSV export -> clean readings table (+ statistics document)
* ``train``   clean readings -> saved pipeline + forecasts / model-info /
              training-run / metrics records
* ``detect``  reading-event stream -> anomalies table (runs until stopped)
* ``load``    the benchmark aggregate (hourly load) over the clean table

``python -m meterlake <job> ...`` runs them from the command line.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from .operators import clean, forecast, profiles, readmodels
from .sinks import tables
from .sources.exports import read_exports
from .sources.readers import load_model, read_first_parquet, read_raw_csv
from .streaming import detect as sdetect
from .streaming import sources as ssrc


def ingest(spark: SparkSession, input_path: str, output_path: str,
           stats_path: str | None = None, sep: str = ",",
           order_col: str | None = None, impute_step_minutes: int = 1,
           rejects_path: str | None = None) -> DataFrame:
    """Raw export -> clean readings (Parquet, overwrite) -> statistics
    document (one profile pass over the written table).

    Missing timestamps are imputed in ``order_col`` order; without an order
    column in file order (path, then position in the file).

    With ``sep="auto"`` every file is read by its own separator and column order, and
    the lines that cannot be read are written to ``rejects_path`` (JSON lines)."""
    if sep == "auto":
        raw, rejects = read_exports(spark, input_path)
        if rejects_path:
            tables.write_json_lines(rejects, rejects_path, mode="overwrite")
        if order_col is not None:
            raw = raw.drop(*clean.FILE_POSITION)
    else:
        raw = read_raw_csv(spark, input_path, sep=sep)
        if order_col is None:
            raw = clean.with_file_position(raw)
    if raw.isEmpty():       # cleaning drops no row
        raise ValueError(f"no readings in {input_path}")
    cleaned = clean.clean(raw, order_by=order_col, impute_step_minutes=impute_step_minutes,
                          file_order=order_col is None)
    tables.staged_write(cleaned, output_path)
    written = spark.read.parquet(output_path)
    if stats_path:
        tables.write_document(profiles.statistics_document(written), stats_path)
    return written


def train(spark: SparkSession, readings: DataFrame, registry: str,
          configs: list[dict] = forecast.MODEL_CONFIGS,
          model_copies: tuple[str, ...] = ()) -> dict:
    """Fit the pipeline and write the model (to ``registry/model`` and every
    further location in ``model_copies``) and its run records under ``registry``
    (forecasts/, model_info/, training_runs/, metrics/).  A run that cannot be
    fitted (empty data, too few features, no configuration) is recorded as
    FAILED, one that breaks off afterwards as CRASHED, with the configuration;
    both are re-raised."""
    paths = {n: f"{registry}/{n}" for n in ("model", "forecasts", "requests", "model_info",
                                             "training_runs", "metrics")}
    started = time.time()
    stamp = time.strftime("%Y%m%d_%H%M%S", time.gmtime(started))

    def record(status, config=None, error=None, model=stamp):
        tables.append_stamped(forecast.training_run_row(
            spark, model, status, time.time() - started, config, error).drop("created_at"),
            paths["training_runs"])

    try:
        result = forecast.train(readings, configs,
                                predictions_path=f"{registry}/predictions/{stamp}-{time.time_ns()}")
    except Exception as e:
        record("FAILED", configs[-1] if configs else None, str(e))
        raise
    name = result.model_timestamp
    try:
        saved = tables.save_model(result.model, *[f"{p}/{name}" for p in (paths["model"], *model_copies)])
        tables.append_forecasts(result.predictions, paths["forecasts"], "holdout")
        tables.append_stamped(forecast.model_info_row(spark, result).drop("created_at"),
                              paths["model_info"])
        tables.write_json_lines(forecast.metrics_line(spark, result), paths["metrics"])
    except Exception as e:
        record("CRASHED", result.config, str(e), name)
        raise
    record("SUCCESS", result.config, None, name)
    return {"result": result, **paths, "model_path": saved[0]}


def latest_model(spark: SparkSession, registry: str):
    """(fitted pipeline, its info row) of the newest model of a registry, by the
    creation time of its info row."""
    info = readmodels.latest(spark.read.parquet(f"{registry}/model_info"), "created_at").first()
    return load_model(f"{registry}/model/{info.model_timestamp}"), info


def detect(spark: SparkSession, table: str, checkpoint: str, source: str = "files",
           path: str | None = None, bootstrap_servers: str | None = None,
           topic: str | None = None, trigger: str = "10 seconds",
           available_now: bool = False, output_format: str = "parquet"):
    """Start the stream detector.  ``source`` is explicit: 'files' (JSON
    payload lines under ``path``), 'kafka' or 'rate' (simulation)."""
    if source == "files":
        stream = ssrc.file_stream(spark, path)
    elif source == "kafka":
        stream = ssrc.kafka_stream(spark, bootstrap_servers, topic)
    elif source == "rate":
        stream = ssrc.rate_stream(spark)
    else:
        raise ValueError(f"unknown source {source!r}")
    return sdetect.start_detection(stream, table, checkpoint, processing_time=trigger,
                                   available_now=available_now, output_format=output_format)


def load(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The benchmark aggregate over the first readable clean table."""
    readings, _ = read_first_parquet(spark, paths)
    return profiles.hourly_load(readings, voltage="Voltage")
