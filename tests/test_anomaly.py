"""3-sigma detection on literal groups (edge cases of the rule)."""

import math

from pyspark.sql import functions as F

from meterlake.operators import anomaly

SCHEMA = "device_id string, active_power double, is_injected_anomaly boolean"


def _rows(device, values, injected=False):
    return [(device, v, injected) for v in values]


def _detect(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return {(r.device_id, r.active_power, r.is_anomaly) for r in anomaly.detect(df, **kw).collect()}


def test_small_groups_are_not_scored(spark):
    rows = _rows("a", [1.0]) + _rows("b", [1.0, 100.0])
    assert _detect(spark, rows) == set()


def test_three_is_enough_but_cannot_fire(spark):
    # n=3 is scored, but |z| <= (n-1)/sqrt(n) < 3
    assert _detect(spark, _rows("a", [0.0, 0.0, 1000.0])) == set()


def test_bound_n10_never_fires_n11_does(spark):
    ten = _rows("a", [1.0] * 9 + [1000.0])
    assert _detect(spark, ten) == set()
    eleven = _rows("b", [1.0] * 10 + [1000.0])
    out = _detect(spark, eleven)
    assert ("b", 1000.0, True) in out and len(out) == 1
    # the bound itself
    assert (10 - 1) / math.sqrt(10) < 3 < (11 - 1) / math.sqrt(11)


def test_constant_group_has_no_outlier(spark):
    assert _detect(spark, _rows("a", [2.5] * 20)) == set()


def test_injected_rows_are_kept_even_inside_bounds(spark):
    rows = _rows("a", [1.0, 2.0, 3.0]) + [("a", 2.0, True)]
    out = _detect(spark, rows)
    assert out == {("a", 2.0, False)}


def test_null_and_nan_power(spark):
    rows = _rows("a", [1.0, 2.0, 3.0, 2.0]) + [("a", None, True), ("a", None, False)]
    df = spark.createDataFrame(rows, SCHEMA)
    stats = anomaly.group_stats(df).collect()[0]
    assert stats["count"] == 4  # NULL readings are not counted
    out = anomaly.detect(df).collect()
    # NULL power: flag is NULL; kept only because injected
    assert [(r.active_power, r.is_anomaly) for r in out] == [(None, None)]


def test_quality_counts(spark):
    rows = _rows("b", [1.0] * 10 + [1000.0]) + [("b", 1.0, True)]
    q = anomaly.quality(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    assert q.n_readings == 12 and q.n_injected == 1
    assert q.true_positives + q.false_negatives == 1


def test_stats_join_is_broadcast(spark):
    from meterlake.sources import fixtures as fx
    from conftest import SF_SMALL
    plan = anomaly.detect(fx.readings(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_one_nan_reading_flags_nothing_else(spark):
    rows = [("a", 1.0 + i / 100) for i in range(29)] + [("a", float("nan")), ("a", 500.0)]
    df = spark.createDataFrame(rows, "device_id string, active_power double")
    out = anomaly.detect(df, injected=None).collect()
    assert [r.active_power for r in out] == [500.0]
    stats = anomaly.group_stats(df).first()
    assert stats["count"] == 30 and stats["mean"] == stats["mean"]


def test_building_detection_starts_no_job(spark):
    df = spark.createDataFrame([("a", 1.0)] * 5, "device_id string, active_power double")
    sc = spark.sparkContext
    sc.setJobGroup("build-only", "building a plan")
    try:
        anomaly.detect(df)
        assert not sc.statusTracker().getJobIdsForGroup("build-only")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
