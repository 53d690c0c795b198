"""Read models, validation, sinks/DDL and the regression pipeline."""

import datetime as dt
import os

from pyspark.sql import functions as F

from meterlake.operators import forecast, readmodels
from meterlake.sinks import tables
from meterlake.sources import fixtures as fx
from meterlake.sources.readers import constant_table, load_model, read_first_parquet

from conftest import SF_SMALL


def test_validation_messages(spark):
    df = spark.createDataFrame(
        [(1, "600", "5", "-1", "0", "0", "24", "0", "13"),
         (2, "230", "abc", "0", "0", "0", "1", "1", "1"),
         (3, None, None, None, None, None, None, None, None)],
        "id int, Voltage string, current string, Sub_metering_1 string, Sub_metering_2 string, "
        "Sub_metering_3 string, hour string, day_of_week string, month string")
    out = {r.id: r for r in readmodels.validate(df).collect()}
    assert out[1].errors == ["Voltage should be between 0 and 500V",
                             "Sub_metering_1 should be a positive value",
                             "Hour should be between 0 and 23",
                             "Day of week should be between 1 and 7",
                             "Month should be between 1 and 12"]
    assert out[2].errors == ["Current must be a valid number"]
    assert out[3].is_valid and out[3].day_of_week == 1


def test_topk_and_latest(spark):
    df = spark.range(1000).select(F.col("id").alias("event_id"),
                                  F.timestamp_seconds("id").cast("timestamp_ntz").alias("timestamp"))
    top = readmodels.newest(df, 10)
    assert [r.event_id for r in top.collect()] == list(range(999, 989, -1))
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert readmodels.latest(df, "event_id").collect()[0].event_id == 999


def test_new_since_and_overlay(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    inc = spark.createDataFrame([("a", x, 1.0) for x in t] + [("b", t[0], 1.0)],
                                "device_id string, timestamp timestamp_ntz, value double")
    known = spark.createDataFrame([("a", t[0]), ("a", t[0])], "device_id string, timestamp timestamp_ntz")
    # another device at a known time is new
    assert {(r.device_id, r.timestamp) for r in readmodels.new_since(inc, known).collect()} == {
        ("a", t[1]), ("a", t[2]), ("b", t[0])}
    f = spark.createDataFrame([(t[0], 1.0, 1.1)], "timestamp timestamp_ntz, active_power double, prediction double")
    a = spark.createDataFrame([(t[1], 9.0)], "timestamp timestamp_ntz, active_power double")
    s = {(r.series, r.value) for r in readmodels.series_overlay(f, a).collect()}
    assert s == {("forecast", 1.1), ("actual", 1.0), ("anomaly", 9.0)}


def test_formatted_time_passes_bad_text(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",), ("garbage",)], "t string")
    out = [r.f for r in df.select(readmodels.formatted_time("t").alias("f")).collect()]
    assert out == ["2024-01-01 10:00:00", "garbage"]


def test_sinks_ddl_and_fallback(spark, tmp_dir):
    tables.create_result_tables(spark, tmp_dir, database=None)
    assert {"anomalies", "forecasts", "model_info", "training_runs"} <= {
        t.name for t in spark.catalog.listTables()}
    df = spark.range(3)
    first = os.path.join(tmp_dir, "a")
    written = tables.write_with_fallback(df, [("nonexistent-format", first), ("parquet", first)])
    assert written == first
    got, p = read_first_parquet(spark, [os.path.join(tmp_dir, "missing"), first])
    assert p == first and got.count() == 3
    tables.write_parquet(df.withColumn("p", F.col("id") % 2), os.path.join(tmp_dir, "pq"),
                         partition_by=["p"])
    assert {"p=0", "p=1", "_SUCCESS"} <= set(os.listdir(os.path.join(tmp_dir, "pq")))
    tables.write_csv(df, os.path.join(tmp_dir, "csv"), single_file=True)
    assert len([f for f in os.listdir(os.path.join(tmp_dir, "csv")) if f.endswith(".csv")]) == 1
    for name in ("anomalies", "forecasts", "model_info", "training_runs"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_registry_rows_on_duplicates(spark):
    info = spark.createDataFrame([("m1", 1.0, 5), ("m2", 2.0, 3), ("m1", 0.5, 9)], "model_timestamp string, rmse double, created_at int")
    arts = spark.createDataFrame([("p", "m1", "x/1"), ("p", "m2", "x/2"), ("p", "m2", "y/2"), ("q", "m3", "z")],
                                 "kind string, model_timestamp string, path string")
    assert readmodels.latest(info, "created_at").first().rmse == 0.5
    got = {r.kind: (r.path, r.rmse) for r in readmodels.artifact_info(arts, info).collect()}
    assert got == {"p": ("y/2", 2.0), "q": ("z", None)}


def test_results_before_anything_was_written(spark, tmp_dir):
    out = tables.read_result(spark, os.path.join(tmp_dir, "none"), "anomalies")
    assert out.count() == 0 and "lower_bound" in out.columns


def test_training_gates_and_records(spark, tmp_dir):
    import pytest

    from meterlake import jobs
    r = fx.readings(spark, SF_SMALL)
    small = [{"numTrees": 2, "maxDepth": 2}]
    with pytest.raises(ValueError, match="empty"):
        jobs.train(spark, r.limit(0), f"{tmp_dir}/empty", small)
    run = spark.read.parquet(f"{tmp_dir}/empty/training_runs").first()
    assert (run.status, run.config) == ("FAILED", small[0]) and "empty" in run.error_message
    blocked = f"{tmp_dir}/file"
    open(blocked, "w").close()
    t = jobs.train(spark, r, f"{tmp_dir}/reg", small, model_copies=(f"{tmp_dir}/copy", blocked))
    assert all(load_model(p) for p in (t["model_path"], t["model_path"].replace("/reg/model/", "/copy/")))
    model, info = jobs.latest_model(spark, f"{tmp_dir}/reg")
    assert info.model_timestamp == t["result"].model_timestamp and len(model.stages) == 5
    os.makedirs(f"{tmp_dir}/bad")
    open(f"{tmp_dir}/bad/forecasts", "w").close()       # a file where the table should be
    with pytest.raises(Exception):
        jobs.train(spark, r, f"{tmp_dir}/bad", small)
    run = spark.read.parquet(f"{tmp_dir}/bad/training_runs").first()
    assert (run.status, run.config) == ("CRASHED", small[0])


def test_missing_values_are_filled_from_the_training_side_only(spark):
    rows = [(i, 1.0 if i % 5 else 100.0, 230.0, float(i % 7)) for i in range(200)]
    rows += [(1001, None, 230.0, 1.0), (1000, None, 230.0, 1.0)]
    df = spark.createDataFrame(rows, "event_id long, current double, Voltage double, active_power double")
    train_df, test_df = forecast.split(forecast.prepare(df))
    assert forecast.training_means(train_df) == (161, {"current": 1.0, "reactive_power": 0.0})
    no_key = forecast.prepare(df.drop("event_id").withColumn("timestamp", F.lit("2024-01-01 10:00:00")))
    sides = [tuple(sorted(x.toPandas().current.dropna())) for x in forecast.split(no_key)]
    assert sides == [tuple(sorted(x.toPandas().current.dropna())) for x in forecast.split(no_key.repartition(7))]
    assert test_df.count() == 41


def test_queries_do_not_change_each_other(spark):
    from meterlake.plans.catalog import QUERIES
    before = sorted(map(str, QUERIES["forecast_table"](spark, SF_SMALL).collect()))
    one = QUERIES["score_requests"](spark, SF_SMALL)
    assert one.filter("active_power IS NOT NULL").count() == 0
    QUERIES["score_requests"](spark, SF_SMALL)
    assert sorted(map(str, QUERIES["forecast_table"](spark, SF_SMALL).collect())) == before
    assert one.count() == one.select("event_id").distinct().count()


def test_constant_table(spark):
    from pyspark.sql import types as T
    schema = T.StructType.fromDDL("a int, b double, s string, f boolean")
    rows = [(1, 0.1 + 0.2, "it's", True), (None, float("nan"), None, None)]
    out = constant_table(spark, rows, schema).collect()
    assert out[0].b == 0.1 + 0.2 and out[0].s == "it's" and out[1].a is None


def test_regression_pipeline_save_load_score(spark, tmp_dir):
    r = fx.readings(spark, SF_SMALL)
    res = forecast.train(r, configs=[{"numTrees": 5, "maxDepth": 3}])
    assert res.config == {"numTrees": 5, "maxDepth": 3}
    assert res.train_rows + res.test_rows == r.count()
    assert 0.0 <= res.metrics["rmse"] and abs(res.metrics["mse"] - res.metrics["rmse"] ** 2) < 1e-9
    path = os.path.join(tmp_dir, "model")
    tables.save_model(res.model, path)
    model = load_model(path)
    req = readmodels.validate(fx.requests(spark, SF_SMALL)).filter("is_valid").limit(5)
    preds = forecast.score(model, req).collect()
    assert len(preds) == 5 and all(p.prediction is not None for p in preds)


def test_evaluate_matches_formula(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5)], "active_power double, prediction double")
    m = forecast.evaluate(df).collect()[0]
    assert abs(m.mse - (0.25 + 0.25 + 0.25) / 3) < 1e-12
    assert abs(m.mae - 0.5) < 1e-12
    assert abs(m.r2 - (1 - 0.75 / 2.0)) < 1e-12


def test_training_rows_are_dealt_evenly(spark, monkeypatch):
    seen = []

    class Fake:
        def __init__(self, real):
            self.real = real

        def fit(self, df):
            seen.append((df.storageLevel.useDisk, df.rdd.glom().map(len).collect()))
            return self.real.fit(df)

    build = forecast.build_pipeline
    monkeypatch.setattr(forecast, "PARTITION_ROWS", 100, raising=False)
    monkeypatch.setattr(forecast, "build_pipeline", lambda *a, **k: Fake(build(*a, **k)))
    r = fx.readings(spark, SF_SMALL).coalesce(1)
    res = forecast.train(r, configs=[{"numTrees": 2, "maxDepth": 2}])
    (kept, sizes), = seen
    assert kept and sum(sizes) == res.train_rows and len(sizes) == -(-res.train_rows // 100)
    assert max(sizes) <= 150        # all rows in one partition before
    assert not spark.sparkContext._jsc.getPersistentRDDs()      # and nothing is kept afterwards


def test_forest_keeps_the_node_of_each_row():
    forest = forecast.build_pipeline(["Voltage", "hour"], 2, 2, {}).getStages()[-1]
    assert forest.getCacheNodeIds() and forest.getCheckpointInterval() == -1


def test_requests_are_scored_in_even_partitions(spark, monkeypatch):
    from meterlake.plans.catalog import QUERIES
    plans = []
    score = forecast.score
    monkeypatch.setattr(forecast, "score", lambda m, v: plans.append(
        v._jdf.queryExecution().optimizedPlan().toString()) or score(m, v))
    QUERIES["score_requests"](spark, SF_SMALL)
    assert "RebalancePartitions" in plans[0]
