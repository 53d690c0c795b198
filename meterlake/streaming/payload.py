"""Reading events as JSON payloads: encode (producer side) and parse
(stream side).  Both are built-in ``to_json`` / ``from_json``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import READING_EVENT


def event_json(columns: list[str] | None = None, ts: str = "timestamp") -> Column:
    """A reading's JSON text in the D3 event layout (timestamp as epoch
    seconds); of ``columns`` (default: all of the layout) the rest is NULL."""
    fields = []
    for f in READING_EVENT.fields:
        if f.name == "timestamp":
            c = F.unix_seconds(F.col(ts).cast("timestamp"))
        else:
            present = columns is None or f.name in columns
            c = F.col(f.name).cast(f.dataType) if present else F.lit(None).cast(f.dataType)
        fields.append(c.alias(f.name))
    return F.to_json(F.struct(*fields))


def encode(readings: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Readings -> one JSON text column ``value``."""
    return readings.select(event_json(readings.columns, ts).alias("value"))


def parse(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON text (or bytes) -> typed event columns.  A malformed payload
    yields a row of NULLs (PERMISSIVE), never an error (see :func:`rejects`).
    A missing injected flag counts as false; adds ``timestamp_dt`` from epoch
    seconds."""
    data = F.from_json(F.col(column).cast("string"), READING_EVENT)
    df = raw.select(data.alias("data")).select("data.*")
    return df.withColumn("is_injected_anomaly", F.coalesce("is_injected_anomaly", F.lit(False))).withColumn(
        "timestamp_dt", F.timestamp_seconds("timestamp").cast("timestamp_ntz"))


def rejects(raw: DataFrame, column: str = "value") -> DataFrame:
    """One row: payloads, and those rejected (NULL, not a JSON object, or
    without a timestamp or device)."""
    data = F.from_json(F.col(column).cast("string"), READING_EVENT)
    bad = data.isNull() | data["timestamp"].isNull() | data["device_id"].isNull()
    return raw.agg(F.count(F.lit(1)).alias("n_payloads"), F.count_if(F.coalesce(bad, F.lit(True))).alias("n_rejected"))
