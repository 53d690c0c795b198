import datetime

from pyspark.sql import functions as F

from meterlake.operators import readmodels
from meterlake.streaming import new_rows

SCHEMA = "device_id string, timestamp timestamp_ntz, value double"
START = datetime.datetime(2024, 1, 1)


def _rows(hours, devices=("a", "b")):
    return [(d, START + datetime.timedelta(hours=h), float(h)) for h in hours for d in devices]


def _run(spark, folder, known=None, delay="5 hours"):
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{folder}/in"))
    q = new_rows.report_new(stream, f"{folder}/out", f"{folder}/ckpt", known, delay, available_now=True)
    q.awaitTermination()
    return q


def _add(spark, folder, i, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{i}")


def test_batches_with_repeats_and_a_restart(spark, tmp_dir):
    known = spark.createDataFrame(_rows([1, 6], ("a",)), SCHEMA)
    everything = []
    for i in range(6):
        # two new hours, the last four again, one row twice in the batch, nulls
        rows = _rows(range(max(0, 2 * i - 4), 2 * i + 2)) + _rows([2 * i], ("a",)) + [(None, START, 0.0), ("a", None, 0.0)]
        _add(spark, tmp_dir, i, rows)
        everything += rows
        if i in (2, 5):
            _run(spark, tmp_dir, known)             # the second time after a restart
    got = spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/out")
    batch = spark.createDataFrame(everything, SCHEMA).dropna().distinct()
    want = readmodels.new_since(batch, known)
    assert got.count() == want.count() == 22
    assert got.exceptAll(want.select(got.columns)).isEmpty()


def test_state_is_bounded_by_the_watermark(spark, tmp_dir):
    for i in range(8):
        _add(spark, tmp_dir, i, _rows(range(10 * i, 10 * i + 10)))
    q = _run(spark, tmp_dir)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/out").count() == 160
    # five hours of two devices behind the newest, and the batch that has just come
    assert max(held) <= 2 * (10 + 10 + 6) < 160
    # a row behind the watermark is not reported again
    _add(spark, tmp_dir, 8, _rows([0]))
    _run(spark, tmp_dir)
    assert spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/out").filter(F.col("value") == 0).count() == 2


def test_number_of_batches_does_not_grow_with_the_files(spark, monkeypatch):
    from conftest import SF_SMALL
    from meterlake.plans import queries_serving
    queries = []
    report, keep = new_rows.report_new, queries_serving.kept_lookup
    monkeypatch.setattr(new_rows, "report_new", lambda *a, **k: queries.append(report(*a, **k)) or queries[-1])
    monkeypatch.setattr(queries_serving, "kept_lookup", lambda df, name: keep(df.repartition(24), name))
    spark.conf.set("spark.sql.files.minPartitionNum", "24")     # a task for each of the 24 files
    try:
        got = queries_serving.stream_new_anomalies(spark, SF_SMALL)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    want = queries_serving.new_anomalies(spark, SF_SMALL)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(got.columns)).isEmpty()
    # four batches a run, and one without data; before, one for each two files
    assert queries[-1].lastProgress["batchId"] < 10
