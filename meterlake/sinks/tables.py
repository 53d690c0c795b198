"""Sinks: Parquet / CSV / JSON writers, result-table appends and DDL.

All writes are distributed (each task writes its own files); nothing is
converted to pandas on the driver.  Appends to result tables add a
``created_at`` stamp.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ANOMALIES, FORECASTS, MODEL_INFO, TRAINING_RUNS


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def staged_write(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write beside ``path`` and publish by renaming: readers see the old table or the
    whole new one, and a write that fails leaves the old table and no other file.  For
    stores where renaming a folder is one step."""
    spark = df.sparkSession
    side, old = (f"{path.rstrip('/')}.{what}-{uuid.uuid4().hex[:12]}" for what in ("staged", "old"))
    place = spark._jvm.org.apache.hadoop.fs.Path
    fs = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.format(fmt).option("header", "true").save(side)
    except Exception:
        fs.delete(place(side), True)
        raise
    replaced = fs.exists(place(path))
    if replaced and not fs.rename(place(path), place(old)):
        fs.delete(place(side), True)
        raise IOError(f"cannot replace {path}")
    if not fs.rename(place(side), place(path)):
        if replaced:
            fs.rename(place(old), place(path))
        fs.delete(place(side), True)
        raise IOError(f"cannot publish {path}")
    if replaced:
        fs.delete(place(old), True)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              single_file: bool = False) -> None:
    """CSV with header.  ``single_file`` is for small, bounded outputs only
    (it funnels the data through one task)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", str(header).lower()).csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_with_fallback(df: DataFrame, targets: list[tuple[str, str]]) -> str:
    """Write to the first target (format, path) that accepts the data; a target that
    fails is left as it was."""
    errors = []
    for fmt, path in targets:
        try:
            staged_write(df, path, fmt)
            return path
        except Exception as e:  # noqa: BLE001 - any storage failure moves on
            errors.append(f"{fmt}:{path}: {e}")
    raise IOError("all write targets failed: " + "; ".join(errors))


def write_document(doc: DataFrame, path: str) -> None:
    """The one-row statistics document as a JSON file."""
    doc.coalesce(1).write.mode("overwrite").json(path)


def append_stamped(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows to a result table with a ``created_at`` stamp."""
    df.withColumn("created_at", F.current_timestamp()).write.mode("append").format(fmt).save(path)


def append_forecasts(predictions: DataFrame, path: str, source: str) -> None:
    """Forecast rows tagged with their source: 'holdout' predictions with the
    actual value, or scored 'request's, whose actual value is NULL."""
    out = predictions
    if source == "request":
        out = out.withColumn("active_power", F.lit(None).cast("double"))
    cols = [(F.col(f.name) if f.name in out.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in FORECASTS.fields[:-2]]
    append_stamped(out.select(*cols, F.lit(source).alias("source")), path)


RESULT_TABLES = {"anomalies": ANOMALIES, "forecasts": FORECASTS, "model_info": MODEL_INFO,
                 "training_runs": TRAINING_RUNS}


def create_result_tables(spark: SparkSession, location: str, database: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS for the four result tables (Parquet, at
    ``location/<name>``); anomalies are partitioned by batch."""
    prefix = f"{database}." if database else ""
    for name, schema in RESULT_TABLES.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        part = " PARTITIONED BY (batch_id)" if name == "anomalies" else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({cols}) USING parquet{part} "
                  f"LOCATION '{location}/{name}'")
    # batches that were written before the table was made
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/anomalies")
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        recover_partitions(spark, f"{prefix}anomalies")


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions that were written to a table's location visible in it."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def read_result(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A result table by its path; with its columns and no rows where nothing
    has been written yet."""
    schema = RESULT_TABLES[name]
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def save_model(model, *paths: str) -> list[str]:
    """Save a fitted pipeline to every location (overwrite).  Returns those
    that accepted it; an error if none did."""
    saved, errors = [], []
    for path in paths:
        try:
            model.write().overwrite().save(path)
            saved.append(path)
        except Exception as e:  # noqa: BLE001 - the other locations are still tried
            errors.append(f"{path}: {e}")
    if not saved:
        raise IOError("no location accepted the model: " + "; ".join(errors))
    return saved
