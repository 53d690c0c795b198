import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from meterlake.operators import readmodels, sampling
from meterlake.plans import queries_ml
from meterlake.sinks import tables
from conftest import SF_SMALL


@pytest.mark.parametrize("digits,few", [(4, 10_000), (1, 3)])
def test_exact_sample_equals_bottom_k(spark, monkeypatch, digits, few):
    monkeypatch.setattr(sampling, "DIGITS", digits)
    monkeypatch.setattr(sampling, "FEW", few)
    rows = [(i, i % 7) for i in range(400)] + [(7, 0)] * 200 + [(None, 1)] * 3     # a hot key
    df = spark.createDataFrame(rows, "k long, v long").repartition(3)
    order = sorted(r[0] for r in df.select(sampling.seeded_hash("k")).collect())
    for n in (-1, 0, 1, 100, 299, 402, 602, 603, 5000):
        got = sampling.exact_sample(df, n, "k")
        assert sorted(r[0] for r in got.select(sampling.seeded_hash("k")).collect()) == order[:max(0, n)]
    assert sampling.exact_sample(df.limit(0), 5, "k").count() == 0


def _fails(df):
    return df.withColumn("v", F.when(F.col("k") < 90, F.col("v")).otherwise(F.raise_error(F.lit("no space")).cast("long")))


def test_failed_write_leaves_the_old_table(spark, tmp_dir):
    df = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v")).repartition(4, "k")
    path = f"{tmp_dir}/t"
    with pytest.raises(Exception, match="no space"):
        tables.staged_write(_fails(df), path)
    assert glob.glob(f"{tmp_dir}/t*") == []                 # nothing readable, no part files
    tables.staged_write(df, path)
    tables.staged_write(df.filter("k < 50"), path)          # replaced as a whole
    with pytest.raises(Exception, match="no space"):
        tables.staged_write(_fails(df), path)
    assert spark.read.parquet(path).count() == 50
    assert [os.path.basename(p) for p in glob.glob(f"{tmp_dir}/t*")] == ["t"]
    used = tables.write_with_fallback(df, [("no-such-format", f"{tmp_dir}/a"), ("csv", f"{tmp_dir}/b")])
    assert used == f"{tmp_dir}/b" and not os.path.exists(f"{tmp_dir}/a")
    assert spark.read.option("header", "true").csv(used).count() == 100


def test_newest_rows_open_the_newest_days_only(spark, tmp_dir):
    start = datetime.datetime(2024, 1, 1)
    rows = [(start + datetime.timedelta(hours=5 * i), i) for i in range(200)] + [(None, 900), (None, 901)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, event_id long")
    path = f"{tmp_dir}/by-day"
    readmodels.write_by_day(df, path)
    want = lambda k: [r.event_id for r in readmodels.newest(df, k).collect()]
    read = lambda k: [r.event_id for r in readmodels.newest_by_day(spark.read.schema(
        "timestamp timestamp_ntz, event_id long, day date").parquet(path), k).collect()]
    for k in (1, 5, 60, 199, 201, 500):
        assert read(k) == want(k)
    for f in glob.glob(f"{path}/day=2024-01-0*/*.parquet"):     # the oldest days cannot be read any more
        with open(f, "wb") as broken:
            broken.write(b"broken")
    assert read(100) == want(100)


def test_stored_predictions_are_the_saved_model_s(spark):
    t = queries_ml.trained(spark, SF_SMALL)
    from meterlake.operators import forecast
    from meterlake.sources import fixtures as fx
    from meterlake.sources.readers import load_model
    _, held_out = forecast.split(forecast.prepare(fx.readings(spark, SF_SMALL)))
    again = {r.event_id: r.prediction for r in load_model(t["model_path"]).transform(held_out).collect()}
    stored = spark.read.parquet(t["forecasts"]).filter("source = 'holdout'").collect()
    assert len(stored) == len(again) > 0
    assert all(abs(r.prediction - again[r.event_id]) < 1e-9 for r in stored)
