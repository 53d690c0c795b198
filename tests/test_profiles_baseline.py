"""Profiles, the statistics document round trip and the calibrated baseline."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlake.operators import baseline, profiles
from meterlake.sinks.tables import write_document
from meterlake.sources import document

SCHEMA = "timestamp timestamp_ntz, active_power double, voltage int"


def _readings(spark):
    rows = [
        (dt.datetime(2024, 1, 1, 10), 2.0, 230),   # Monday, winter
        (dt.datetime(2024, 1, 1, 10, 30), 4.0, 232),
        (dt.datetime(2024, 1, 6, 10), 6.0, 228),   # Saturday
        (dt.datetime(2024, 7, 2, 11), 1.0, 240),   # Tuesday, summer
        (dt.datetime(2024, 4, 3, 11), 3.0, 235),   # Wednesday, other
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_hourly_and_daytype_profiles(spark):
    r = _readings(spark)
    h = {x.hour_of_day: x for x in profiles.hourly_profile(r).collect()}
    assert h[10].avg_active_power == 4.0 and h[10].min_voltage == 228
    assert h[11].max_active_power == 3.0
    wd = {x.hour_of_day: x.weekday_avg_power for x in profiles.weekday_profile(r).collect()}
    we = {x.hour_of_day: x.weekend_avg_power for x in profiles.weekend_profile(r).collect()}
    assert wd == {10: 3.0, 11: 2.0} and we == {10: 6.0}


def test_single_reading_stddev_is_null(spark):
    r = _readings(spark).filter(F.hour("timestamp") == 11).limit(1)
    assert profiles.overall_profile(r).collect()[0].overall_stddev_power is None


def test_profile_pass_matches_direct_profiles(spark):
    r = _readings(spark)
    p = profiles.profile_pass(r)
    total = p.filter("is_total").collect()[0]
    direct = profiles.overall_profile(r).collect()[0]
    assert total.avg_active_power == direct.overall_avg_power
    assert total.stddev_active_power == direct.overall_stddev_power
    assert p.filter("NOT is_total").count() == 2


def test_document_round_trip_and_defaults(spark, tmp_dir):
    r = _readings(spark)
    path = f"{tmp_dir}/doc"
    write_document(profiles.statistics_document(r), path)
    doc = document.read_document(spark, path).collect()[0]
    assert [h.hour_of_day for h in doc.hourly_stats] == [10, 11]
    assert doc.winter_stats.winter_avg_power == 4.0
    # absent file -> whole default profile
    d = document.read_document(spark, f"{tmp_dir}/missing").collect()[0]
    assert len(d.hourly_stats) == 24 and d.overall_stats.overall_avg_power == 2.2
    # incomplete file (a section missing) -> defaults too
    spark.createDataFrame([(1,)], "x int").select(F.struct(F.lit(1.0).alias("winter_avg_power"))
                                                  .alias("winter_stats")).write.json(f"{tmp_dir}/partial")
    p = document.read_document(spark, f"{tmp_dir}/partial").collect()[0]
    assert p.winter_stats.winter_avg_power == 2.5
    rows = document.document_rows(document.read_document(spark, path))
    assert rows.filter("section = 'hourly_stats'").count() == 16


def test_expected_power_factors(spark):
    r = _readings(spark)
    e = {(x.timestamp, x.active_power): x for x in baseline.expected_power(r).collect()}
    sat = e[(dt.datetime(2024, 1, 6, 10), 6.0)]
    assert sat.weekend_factor == pytest.approx(6.0 / 3.0)
    mon = e[(dt.datetime(2024, 1, 1, 10), 2.0)]
    assert mon.weekend_factor == 1.0
    overall = 16.0 / 5
    winter_avg = (2.0 + 4.0 + 6.0) / 3
    assert mon.seasonal_factor == pytest.approx(winter_avg / overall)
    assert mon.expected_power == pytest.approx(4.0 * 1.0 * winter_avg / overall)


def test_seasonal_defaults_when_a_season_is_empty(spark):
    r = _readings(spark).filter(F.month("timestamp") == 1)
    e = baseline.expected_power(r).collect()
    assert {x.seasonal_factor for x in e} == {1.3}


def test_unknown_hour_uses_default_base(spark):
    ref = _readings(spark)
    other = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3), 1.0, 230)], SCHEMA)
    x = baseline.expected_power(other, reference=ref).collect()[0]
    assert x.base_power == 2.0


def test_device_class_and_clamps(spark):
    df = spark.createDataFrame(
        [("meter_5", 0.0, 300, False), ("meter_50", 2.0, 200, True), ("meter_99", 1.0, 0, False),
         ("meter_x", 1.0, 230, None)],
        "device_id string, active_power double, voltage int, is_injected_anomaly boolean")
    out = baseline.clamped(df.withColumn("cls", baseline.device_class("device_id"))).collect()
    assert [x.cls for x in out] == ["large", "average", "small", None]
    assert [x.voltage_clamped for x in out] == [245, 200, 215, 230]
    assert out[0].active_power_clamped == 0.01
    assert out[0].current_derived == round(0.01 / 245, 3)


def test_indented_document_is_read_as_one_row(spark, tmp_path):
    import json

    from meterlake.sinks.tables import write_document
    from meterlake.operators import profiles
    from meterlake.sources import document
    from meterlake.sources import fixtures as fx
    from conftest import SF_SMALL
    write_document(profiles.statistics_document(fx.readings(spark, SF_SMALL)), str(tmp_path / "d"))
    text = next((tmp_path / "d").glob("part-*")).read_text()
    (tmp_path / "pretty.json").write_text(json.dumps(json.loads(text), indent=4))
    docs = [document.read_document(spark, str(tmp_path / x)) for x in ("d", "pretty.json")]
    assert [d.count() for d in docs] == [1, 1] and docs[0].first() == docs[1].first()
    (tmp_path / "broken.json").write_text("{ not json")
    for name in ("broken.json", "absent.json"):
        d = document.read_document(spark, str(tmp_path / name))
        assert d.count() == 1 and d.first().overall_stats.overall_avg_power == 2.2


def test_season_without_readings_has_a_row(spark):
    from meterlake.operators import profiles
    df = spark.sql("SELECT timestamp_ntz'2024-01-05 10:00:00' AS timestamp, 4.0D AS active_power")
    out = {r.season: (r.n, r.avg_power) for r in profiles.season_profile(df).collect()}
    assert out == {"winter": (1, 4.0), "summer": (0, None), "other": (0, None)}
