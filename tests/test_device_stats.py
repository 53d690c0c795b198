import math
import random

from pyspark.sql import functions as F

from meterlake.operators import anomaly, device_stats
from meterlake.plans import joins
from meterlake.streaming import detect as sdetect

SCHEMA = "device_id string, timestamp timestamp_ntz, active_power double"


def _rows(seed, n=900):
    import datetime
    rng = random.Random(seed)
    start = datetime.datetime(2024, 3, 1)
    rows = [(rng.choice(("hot", "hot", "a", "b", "c", None)), start + datetime.timedelta(minutes=37 * i),
             rng.choice((None, math.nan, 1e6 + rng.gauss(0, 1e-3), 1e6 + rng.gauss(5, 2)))) for i in range(n)]
    return rows + [("lone", start, 1.0), ("pair", start, 1.0), ("pair", start + datetime.timedelta(days=9), 3.0),
                   ("empty", start, None)]


def _by_device(df):
    return {r["device_id"]: r for r in df.collect()}


def test_merged_moments_equal_whole_table(spark, tmp_dir):
    """Large means, small deviations: the merge must not cancel."""
    df = spark.createDataFrame(_rows(1), SCHEMA)
    whole = _by_device(anomaly.group_stats(df, min_count=1))
    path = f"{tmp_dir}/moments"
    # two batches share days; one of them is replayed
    odd = F.crc32(F.col("timestamp").cast("string").cast("binary")) % 2 == 1
    for batch, part in ((0, df.filter(odd)), (1, df.filter(~odd)), (0, df.filter(odd))):
        device_stats.add_batch(device_stats.daily_moments(part), path, batch)
    moments = device_stats.read_moments(spark, path)
    device_stats.compact(spark, path, f"{tmp_dir}/compact")
    compact = device_stats.read_moments(spark, f"{tmp_dir}/compact")
    assert compact.count() < moments.count()
    assert compact.count() == compact.select("device_id", "day").distinct().count()
    for table in (moments, compact):
        got = _by_device(device_stats.statistics(table.filter("device_id is not null"), min_count=1))
        assert set(got) == {d for d, r in whole.items() if d and r["count"]}
        for d, r in got.items():
            assert r["count"] == whole[d]["count"]
            assert math.isclose(r["mean"], whole[d]["mean"], rel_tol=1e-12)
            assert r["stddev"] is whole[d]["stddev"] is None or math.isclose(
                r["stddev"], whole[d]["stddev"], rel_tol=1e-6)
    assert device_stats.read_moments(spark, f"{tmp_dir}/none").count() == 0


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_readings_are_not_shuffled(spark, monkeypatch):
    """Below the measured limit the readings meet the statistics without an exchange,
    whatever Spark's static threshold; above it by a shuffle join, with the same rows."""
    df = spark.createDataFrame(_rows(2), SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        few = anomaly.detect(df, k=1.0, keep=True)
        assert "hashpartitioning" not in _plan(few) and "BroadcastHashJoin" in _plan(few)
        rows = sorted(map(str, few.collect()))
        assert rows
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
        many = anomaly.detect(df, k=1.0, keep=True)
        assert "hashpartitioning" in _plan(many)
        assert sorted(map(str, many.collect())) == rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_statistics_over_all_batches(spark, tmp_dir):
    """A batch is judged by all batches so far, and a replayed batch counts once."""
    import datetime
    start = datetime.datetime(2024, 1, 1)
    schema = SCHEMA + ", is_injected_anomaly boolean"
    calm = [("m", start + datetime.timedelta(minutes=i), 10.0 + (i % 5) / 10, False) for i in range(200)]
    spike = [("m", start + datetime.timedelta(days=1), 500.0, False), ("m", start + datetime.timedelta(days=1, hours=1), 10.0, False)]
    first, second = (spark.createDataFrame(x, schema) for x in (calm, spike))
    alone = sdetect.AnomalyBatchWriter(f"{tmp_dir}/alone")
    alone(first, 0)
    alone(second, 1)
    assert alone.counts == {0: 0, 1: 0}             # two readings cannot be judged by themselves
    merged = sdetect.AnomalyBatchWriter(f"{tmp_dir}/merged", moments_path=f"{tmp_dir}/moments")
    for batch, df in ((0, first), (1, second), (1, second)):
        merged(df, batch)
    assert merged.counts == {0: 0, 1: 1}
    moments = device_stats.read_moments(spark, f"{tmp_dir}/moments")
    assert moments.agg(F.sum("n")).first()[0] == 202
    assert [r.active_power for r in spark.read.parquet(f"{tmp_dir}/merged").collect()] == [500.0]
