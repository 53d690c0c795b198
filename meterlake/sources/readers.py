"""Batch sources: raw CSV exports, Parquet tables (single or first of a
candidate list), literal rows, fitted models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_raw_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                 null_token: str = "?", drop_malformed: bool = True,
                 schema: T.StructType | None = None) -> DataFrame:
    """Raw meter export.  Every column is read as text (no inference pass
    over the data); typing happens in ``operators.clean``.  Rows with extra
    fields are dropped.  Column names come from the header, or from an
    explicit all-text ``schema`` (e.g. ``schemas.RAW_READINGS``) for files
    without one."""
    reader = (spark.read.option("header", str(header).lower()).option("sep", sep)
              .option("nullValue", null_token).option("inferSchema", "false")
              .option("mode", "DROPMALFORMED" if drop_malformed else "PERMISSIVE"))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_first_parquet(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, str]:
    """The first location of ``paths`` that resolves (ordered fallback)."""
    errors = []
    for p in paths:
        try:
            return spark.read.parquet(p), p
        except AnalysisException as e:
            errors.append(f"{p}: {e.getMessage() if hasattr(e, 'getMessage') else e}")
    raise FileNotFoundError("no readable location: " + "; ".join(errors))


def _sql_literal(v) -> str:
    import math
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{v}L"
    if isinstance(v, float):
        if math.isnan(v):
            return "double('NaN')"
        if math.isinf(v):
            return "double('Infinity')" if v > 0 else "double('-Infinity')"
        return f"{v!r}D"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def constant_table(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A small, bounded table of flat rows as one SQL ``VALUES`` relation:
    a constant local relation planned without Python workers (and without
    one JVM call per value).  For at most a few hundred rows."""
    if not rows:
        return spark.createDataFrame([], schema)
    names = [f.name for f in schema.fields]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    cols = ", ".join(f"CAST(`{n}` AS {f.dataType.simpleString()}) AS `{n}`"
                     for n, f in zip(names, schema.fields))
    alias = ", ".join(f"`{n}`" for n in names)
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({alias})")


def load_model(path: str):
    """A fitted pipeline (assembler + scaler + regressor) saved by
    ``sinks.tables.save_model``."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
