"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

# Bytes of text handed to an operator's inner loop at a time, so that a task's
# memory depends on its longest row and not on the number of rows in a batch.  The
# words of a slice take some ten times its bytes.
SLICE_BYTES = 2 << 20
# Bytes of an Arrow batch between the JVM and a Python worker (Spark's own limit of
# 64 MB is held several times over by both sides).
BATCH_BYTES = 4 << 20

_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(),
          "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def arrow_type(kind: str) -> pa.DataType:
    """The Arrow type of a simple Spark type name, ``array<...>`` or
    ``struct<name:type,...>`` of simple types."""
    if kind.startswith("array<"):
        return pa.list_(arrow_type(kind[6:-1]))
    if kind.startswith("struct<"):
        return pa.struct([(n, arrow_type(t)) for n, t in
                          (f.split(":") for f in kind[7:-1].split(","))])
    return _ARROW[kind]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back:
    later steps neither recompute them nor depend on an executor's disk."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Batches of at most BATCH_BYTES (or one row) from now on in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` holding about ``size`` bytes of ``column`` each."""
    n = batch.num_rows
    if not n:
        return
    step = max(1, min(n, n * size // max(1, batch.column(column).nbytes)))
    for i in range(0, n, step):
        yield batch.slice(i, step)


def map_column(df: DataFrame, column: str, make: Callable[[], Callable[[list], list[list]]],
               fields: list[tuple[str, str]], size: int = SLICE_BYTES) -> DataFrame:
    """``df`` plus ``fields``, computed from ``column`` in Arrow batches.

    ``make()`` runs once per task and returns a function from a list of values
    to one list of results per field.  An input column whose name is that of a
    field is replaced by it.
    """
    taken = {n.lower() for n, _ in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    names = [f.name for f in kept] + [n for n, _ in fields]
    kinds = [arrow_type(t) for _, t in fields]
    width = len(kept)
    at = next((i for i, f in enumerate(kept) if f.name.lower() == column.lower()), width)
    source = df.select(*[F.col(f"`{f.name}`") for f in kept],
                       *([F.col(f"`{column}`").alias("__in")] if at == width else []))

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, at, size):
                out = work(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    part.columns[:width] + [pa.array(v, type=k) for v, k in zip(out, kinds)], names)

    small_batches(df.sparkSession)
    schema = T.StructType(kept + T.StructType.fromDDL(
        ", ".join(f"`{n}` {t}" for n, t in fields)).fields)
    return source.mapInArrow(run, schema)


def beside(docs: DataFrame, text: str = "text") -> DataFrame:
    """``text`` beside all other columns in one struct ``__row``: an operator
    can add columns without any clash of names."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(F.struct(*others, F.lit(0).alias("__one")).alias("__row"),
                       F.col(f"`{text}`").alias(text))


def restored(rows: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs``, in order, from what ``beside`` made of them."""
    return rows.select(*[(F.col(f"`{c}`") if c == text else F.col(f"__row.`{c}`")).alias(c)
                         for c in docs.columns])
