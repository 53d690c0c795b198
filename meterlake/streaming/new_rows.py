"""Streaming anti-join: anomalies that have not been reported before.

A row is new if its key (device and time) is neither in a static table of known rows
nor among those that the stream has already let through.  The second part is keyed
state: the event time is one of the keys, so Spark forgets a key once the watermark has
passed it, and the state holds the keys of one ``delay`` at most, not the history.  It is
checkpointed with the stream: a restarted query still knows what it reported, and the
file sink's log keeps a replayed batch from being written twice.

Rows later than ``delay`` are dropped, as nobody can tell any more whether they were
reported; rows without a time or a device cannot be recognised and are dropped as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_only(stream: DataFrame, known: DataFrame | None = None, delay: str = "1 day",
             device: str = "device_id", ts: str = "timestamp") -> DataFrame:
    """The rows of ``stream`` whose (device, time) is new."""
    rows = stream.filter(F.col(device).isNotNull() & F.col(ts).isNotNull())
    rows = rows.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", delay)
    if known is not None:
        seen = known.select(F.col(device).alias("_device"), F.col(ts).cast("timestamp").alias("_seen")).distinct()
        rows = rows.join(seen, (F.col(device) == F.col("_device")) & (F.col("_event_time") == F.col("_seen")),
                         "left_anti")
    return rows.dropDuplicates([device, "_event_time"]).drop("_event_time")


def report_new(stream: DataFrame, path: str, checkpoint: str, known: DataFrame | None = None,
               delay: str = "1 day", available_now: bool = False,
               processing_time: str = "10 seconds") -> StreamingQuery:
    """Append the new rows to the Parquet table at ``path``."""
    w = (new_only(stream, known, delay).writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
