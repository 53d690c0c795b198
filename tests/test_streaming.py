"""Stream = batch, restart idempotence, payload parsing, simulation source."""

import os

from pyspark.sql import functions as F

from meterlake.operators import anomaly
from meterlake.sources import fixtures as fx
from meterlake.streaming import detect as sdetect
from meterlake.streaming import payload
from meterlake.streaming import sources as ssrc

from conftest import SF_SMALL


def _readings(spark):
    return fx.readings(spark, SF_SMALL)


def test_payload_round_trip_and_malformed(spark):
    r = _readings(spark).limit(5)
    parsed = payload.parse(payload.encode(r)).collect()
    assert len(parsed) == 5 and all(p.device_id.startswith("meter_") for p in parsed)
    bad = spark.createDataFrame([("{not json",), ('{"device_id": "m"}',)], "value string")
    out = payload.parse(bad).collect()
    assert out[0].device_id is None and out[1].device_id == "m"
    assert out[1].is_injected_anomaly is False     # a missing flag counts as false
    more = bad.unionByName(payload.encode(r)).unionByName(spark.createDataFrame([(None,)], "value string"))
    counts = payload.rejects(more).first()
    assert (counts.n_payloads, counts.n_rejected) == (8, 3)


def test_stream_equals_batch_and_restart_is_idempotent(spark, tmp_dir):
    src, table, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "table", "ckpt"))
    ssrc.publish_files(_readings(spark), src)
    q, writer = sdetect.start_detection(ssrc.file_stream(spark, src), table, ckpt,
                                        available_now=True)
    q.awaitTermination()
    streamed = spark.read.parquet(table)
    batch = anomaly.detect(_readings(spark))
    assert streamed.count() == batch.count() == sum(writer.counts.values())
    # replaying the same batch id overwrites its partition (no duplicates)
    events = payload.parse(spark.read.text(src))
    writer(events, 0)
    assert spark.read.parquet(table).count() == batch.count()
    # a second run on the same checkpoint finds nothing new
    q2, _ = sdetect.start_detection(ssrc.file_stream(spark, src), table, ckpt, available_now=True)
    q2.awaitTermination()
    assert spark.read.parquet(table).count() == batch.count()


def test_multi_batch_statistics_are_per_batch(spark, tmp_dir):
    src, table, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "table", "ckpt"))
    payload.encode(_readings(spark)).repartition(4).write.text(src)
    stream = ssrc.file_stream(spark, src, max_files_per_trigger=1)
    q, writer = sdetect.start_detection(stream, table, ckpt, available_now=True)
    q.awaitTermination()
    out = spark.read.parquet(table)
    assert len(writer.counts) == 4
    assert {r.batch_id: r["count"] for r in out.groupBy("batch_id").count().collect()} == {
        k: v for k, v in writer.counts.items() if v}


def test_empty_batch_is_skipped(spark, tmp_dir):
    writer = sdetect.AnomalyBatchWriter(os.path.join(tmp_dir, "t"))
    empty = spark.createDataFrame([], "device_id string, active_power double, is_injected_anomaly boolean")
    writer(empty, 7)
    assert writer.counts[7] == 0 and not os.path.exists(os.path.join(tmp_dir, "t"))


def test_rate_simulation_source(spark):
    import time
    # an unbounded source: poll with a deadline (processAllAvailable would never return)
    q = (ssrc.rate_stream(spark, rows_per_second=5).writeStream.format("memory")
         .queryName("sim_rate").trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("sim_rate").count() == 0:
            time.sleep(1)
        rows = spark.table("sim_rate").collect()
    finally:
        q.stop()
    assert rows and all(r.device_id == "meter_1" and r.active_power == 2.5 for r in rows)
    # the constant group never yields an outlier (stddev 0)
    assert anomaly.detect(spark.createDataFrame(rows)).filter("is_anomaly").count() == 0


def test_processing_time_trigger_and_late_files(spark, tmp_dir):
    """Processing-time trigger; files arriving later form new batches whose
    statistics cover only their own rows (memoryless per batch)."""
    src, table, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "table", "ckpt"))
    r = _readings(spark)
    first, second = r.filter("event_id % 2 = 0"), r.filter("event_id % 2 = 1")
    payload.encode(first).write.text(os.path.join(src, "a"))
    stream = ssrc.file_stream(spark, os.path.join(src, "*"))
    q, writer = sdetect.start_detection(stream, table, ckpt, processing_time="1 second")
    try:
        q.processAllAvailable()
        payload.encode(second).write.text(os.path.join(src, "b"))
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.read.parquet(table)
    expected = anomaly.detect(first).count() + anomaly.detect(second).count()
    assert out.count() == expected == sum(writer.counts.values())
    assert out.select("batch_id").distinct().count() == 2


def test_anomalies_by_table_name_and_none_found(spark, tmp_dir):
    from meterlake.sinks import tables
    where = os.path.join(tmp_dir, "results")
    spark.sql(f"CREATE DATABASE results_test LOCATION '{where}'")
    try:
        tables.create_result_tables(spark, where, "results_test")
        writer = sdetect.AnomalyBatchWriter(f"{where}/anomalies", table="results_test.anomalies")
        rows = [("a", 1.0, False)] * 10 + [("a", 1000.0, False)]
        df = spark.createDataFrame(rows, "device_id string, active_power double, is_injected_anomaly boolean")
        calm = df.filter("active_power < 2")
        writer(calm, 0)
        assert tables.read_result(spark, f"{where}/anomalies", "anomalies").count() == 0
        writer(df, 1)
        writer(df, 1)      # replayed
        assert [r.active_power for r in spark.table("results_test.anomalies").collect()] == [1000.0]
    finally:
        spark.sql("DROP DATABASE results_test CASCADE")


def test_counts_are_bounded(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sdetect, "KEEP_COUNTS", 2)
    writer = sdetect.AnomalyBatchWriter(os.path.join(tmp_dir, "t"))
    empty = spark.createDataFrame([], "device_id string, active_power double, is_injected_anomaly boolean")
    for i in range(5):
        writer(empty, i)
    assert writer.counts == {3: 0, 4: 0}
