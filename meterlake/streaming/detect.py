"""Per-micro-batch 3-sigma detection with an idempotent result sink.

Each micro-batch runs the same DataFrame function as the batch query
(``operators.anomaly.detect``).  Statistics are those of the batch alone, or, with a
moments table, those merged over all batches so far (``operators.device_stats``); the
batch adds its own moments first, in a partition of its own.  The
sink overwrites the ``batch_id=<id>`` partition of a Parquet table, so a
batch replayed after a failure replaces its own rows instead of
duplicating them.  Errors propagate (the query fails and restarts from its
checkpoint) instead of being swallowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import device_stats
from ..operators.anomaly import detect
from ..plans.joins import kept_lookup
from ..schemas import ANOMALY_COLUMNS


KEEP_COUNTS = 100


class AnomalyBatchWriter:
    """``foreachBatch`` callback: detect, then overwrite this batch's partition."""

    def __init__(self, table_path: str, k: float = 3.0, min_count: int = 3,
                 output_format: str = "parquet", table: str | None = None, moments_path: str | None = None):
        self.table_path = table_path
        self.moments_path = moments_path
        self.table = table
        self.k = k
        self.min_count = min_count
        self.output_format = output_format
        self.counts: dict[int, int] = {}   # anomalies of the KEEP_COUNTS latest batches

    def _count(self, batch_id: int, n: int) -> None:
        self.counts[batch_id] = n
        for old in sorted(self.counts)[:-KEEP_COUNTS]:
            del self.counts[old]

    def _merged(self, batch_df: DataFrame, batch_id: int) -> DataFrame:
        """Statistics over this batch and all before it."""
        device_stats.add_batch(device_stats.daily_moments(batch_df), self.moments_path, batch_id)
        moments = device_stats.read_moments(batch_df.sparkSession, self.moments_path)
        return kept_lookup(device_stats.statistics(moments.filter(F.col("batch") <= batch_id),
                                                   min_count=self.min_count), "device-stats")

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        batch_df = batch_df.persist()
        try:
            if batch_df.isEmpty():
                self._count(batch_id, 0)
                return
            stats = self._merged(batch_df, batch_id) if self.moments_path else None
            found = detect(batch_df, k=self.k, min_count=self.min_count, with_detection_time=True,
                           stats=stats, keep=stats is not None)
            cols = [c for c in ANOMALY_COLUMNS if c in found.columns]
            obs = Observation(f"anomalies_{batch_id}")
            out = (found.select(*cols).withColumn("batch_id", F.lit(batch_id))
                   .observe(obs, F.count(F.lit(1)).alias("n")))
            (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").format(self.output_format).save(self.table_path))
            if self.table:
                batch_df.sparkSession.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS "
                                          f"PARTITION (batch_id = {int(batch_id)})")
                batch_df.sparkSession.catalog.refreshTable(self.table)
            self._count(batch_id, int(obs.get.get("n", 0)))
        finally:
            batch_df.unpersist()


def start_detection(stream: DataFrame, table_path: str, checkpoint: str,
                    processing_time: str | None = "10 seconds", available_now: bool = False,
                    k: float = 3.0, min_count: int = 3, output_format: str = "parquet",
                    table: str | None = None,
                    moments_path: str | None = None) -> tuple[StreamingQuery, AnomalyBatchWriter]:
    """Start the detector.  ``checkpoint`` must be a stable, caller-given
    location so a restart resumes where it stopped.  ``output_format`` is that
    of the anomalies table (``parquet``, or ``json`` for JSON lines); ``table``
    names the SQL table at ``table_path``, if there is one; ``moments_path`` is a
    table of device statistics to be kept up and used over all batches."""
    writer = AnomalyBatchWriter(table_path, k, min_count, output_format, table, moments_path)
    w = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(), writer


def run_available(stream: DataFrame, sink_path: str, checkpoint: str,
                  fmt: str = "parquet") -> None:
    """Drain everything available into a file sink and stop."""
    q = (stream.writeStream.format(fmt).option("path", sink_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
