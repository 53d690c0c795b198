"""Sources/sinks parameters and small rules: separator (S2), JSON-lines
anomaly sink (K7), timestamp repair (P13), run records (K9-K11)."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from meterlake.operators import clean, forecast
from meterlake.plans import queries_ml
from meterlake.sources.readers import read_raw_csv
from meterlake.streaming.detect import AnomalyBatchWriter

from conftest import SF_SMALL


def test_semicolon_separator(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw.txt")
    with open(path, "w") as f:
        f.write("Date;Time;Global_active_power;Global_reactive_power;Voltage;Global_intensity;"
                "Sub_metering_1;Sub_metering_2;Sub_metering_3\n")
        f.write("16/12/2006;17:24:00;4.216;0.418;234.84;18.4;0;1;17\n")
    out = clean.clean(read_raw_csv(spark, path, sep=";")).collect()[0]
    assert out.active_power == 4.216 and out.Sub_metering_3 == 17.0


def test_headerless_file_with_explicit_schema_gives_clean_schema(spark, tmp_dir):
    from meterlake.schemas import CLEAN_READINGS, RAW_READINGS
    path = os.path.join(tmp_dir, "noheader.csv")
    with open(path, "w") as f:
        f.write("16/12/2006,17:24:00,4.216,0.418,234.84,18.4,0,1,17\n")
    out = clean.clean(read_raw_csv(spark, path, header=False, schema=RAW_READINGS))
    assert [(f.name, f.dataType) for f in out.schema.fields] == \
        [(f.name, f.dataType) for f in CLEAN_READINGS.fields]
    assert out.collect()[0].current == 18.4


def test_scoring_request_schema_validates_and_scores(spark):
    from meterlake.operators import readmodels
    from meterlake.schemas import SCORING_REQUEST
    from meterlake.sources.readers import load_model
    req = spark.createDataFrame([(230.0, 5.0, 0.5, 0.3, 0.2, 12, 3, 6),
                                 (600.0, 5.0, 0.5, 0.3, 0.2, 12, 3, 6)], SCORING_REQUEST)
    v = {r.Voltage: r.is_valid for r in readmodels.validate(req).collect()}
    assert v == {230.0: True, 600.0: False}
    t = queries_ml.trained(spark, SF_SMALL)
    scored = forecast.score(load_model(t["model_path"]), readmodels.validate(req).filter("is_valid"))
    assert scored.count() == 1


def test_json_lines_anomaly_sink(spark, tmp_dir):
    rows = [("a", 1.0, False)] * 10 + [("a", 1000.0, False)]
    df = spark.createDataFrame(rows, "device_id string, active_power double, is_injected_anomaly boolean")
    target = os.path.join(tmp_dir, "anomalies_json")
    w = AnomalyBatchWriter(target, output_format="json")
    w(df, 3)
    files = [f for f in os.listdir(os.path.join(target, "batch_id=3")) if f.endswith(".json")]
    lines = [json.loads(x) for f in files for x in open(os.path.join(target, "batch_id=3", f))]
    assert [x["active_power"] for x in lines] == [1000.0] and w.counts[3] == 1


def test_timestamp_repair(spark):
    text = spark.createDataFrame([("2024-01-01 10:00:00", 1.0)], "timestamp string, active_power double")
    out = forecast.prepare(text).collect()[0]
    # absent columns are 0.0 dummies before the missing-value rules (kept as 0.0)
    assert out.hour == 10 and out.month == 1 and out.Voltage == 0.0
    none = spark.createDataFrame([(1.0,)], "active_power double")
    out = forecast.prepare(none).collect()[0]
    assert out.hour is not None and out.current == 0.0


def test_run_records_are_written(spark):
    t = queries_ml.trained(spark, SF_SMALL)
    info = spark.read.parquet(t["model_info"]).collect()
    runs = spark.read.parquet(t["training_runs"]).collect()
    metrics = spark.read.json(t["metrics"]).collect()
    assert len(info) == 1 and runs[0].status == "SUCCESS"
    assert info[0].model_timestamp == runs[0].model_timestamp == metrics[0].model_timestamp
    assert info[0].feature_columns == forecast.FEATURE_COLUMNS
    f = spark.read.parquet(t["forecasts"])
    assert f.filter("source = 'holdout'").count() == t["result"].test_rows


def test_jobs_ingest_train_load(spark, tmp_dir):
    from meterlake import jobs
    from meterlake.sources import fixtures as fx
    raw_dir = os.path.join(tmp_dir, "raw_csv")
    fx.raw_readings(spark, SF_SMALL).write.option("header", "true").csv(raw_dir)
    clean_dir, stats = os.path.join(tmp_dir, "clean"), os.path.join(tmp_dir, "stats")
    out = jobs.ingest(spark, raw_dir, clean_dir, stats, order_col="event_id")
    n = fx.raw_readings(spark, SF_SMALL).count()
    assert out.count() == n and out.filter("timestamp IS NULL").count() == 0
    doc = spark.read.json(stats).collect()[0]
    assert len(doc.hourly_stats) == 24
    t = jobs.train(spark, out, os.path.join(tmp_dir, "registry"),
                   configs=[{"numTrees": 3, "maxDepth": 3}])
    assert spark.read.parquet(t["training_runs"]).first().status == "SUCCESS"
    hourly = jobs.load(spark, [os.path.join(tmp_dir, "nope"), clean_dir]).collect()
    assert len(hourly) == 24


def test_cli_load(spark, tmp_dir, capsys, monkeypatch):
    import meterlake.__main__ as m
    from meterlake.operators import clean as c
    from meterlake.sources import fixtures as fx
    path = os.path.join(tmp_dir, "clean")
    c.clean(fx.raw_readings(spark, SF_SMALL)).write.parquet(path)
    monkeypatch.setattr(m, "get_session", lambda *a, **k: spark)
    monkeypatch.setattr(spark, "stop", lambda: None)  # keep the shared session
    assert m.main(["load", path]) == 0
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("{")]
    # 24 hours plus the NULL hour of rows whose blank date was not imputed
    assert len(lines) == 25


def test_adapter_json_path_matches_json_decoder(spark):
    """The readings adapter reads props.k with a JSON path lookup; it must
    give the same value as a full from_json decode on every row, and NULL
    for malformed or non-integer payloads."""
    from meterlake.sources import fixtures as fx
    ev = fx.table(spark, SF_SMALL, "events")
    diff = ev.filter(~fx._k().eqNullSafe(F.from_json("props", "k INT").getField("k")))
    assert ev.count() > 0 and diff.count() == 0
    odd = spark.createDataFrame([('{"k": 7}',), ('{"k": "x"}',), ("not json",), ('{"j": 1}',)],
                                "props string")
    assert [r[0] for r in odd.select(fx._k()).collect()] == [7, None, None, None]
