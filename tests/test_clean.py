"""Cleaning rules on literal raw rows and CSV files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterlake import jobs
from meterlake.operators import clean
from meterlake.sources.readers import read_raw_csv

HEADER = "Date,Time,Global_active_power,Global_reactive_power,Voltage,Global_intensity,Sub_metering_1,Sub_metering_2,Sub_metering_3"


def _write(tmp_dir, lines, name="raw.csv"):
    path = f"{tmp_dir}/{name}"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_csv_clean_rules(spark, tmp_dir):
    path = _write(tmp_dir, [
        HEADER,
        "16/12/2006,17:24:00,4.216,0.418,234.84,18.4,0,1,17",
        "1/2/2007,00:00:00,?,?,?,?,?,?,?",                # unpadded date, all missing
        "16/12/2006,17:26:00,5.0,0.6,233.0,20.0,0,2,16,EXTRA",  # extra field -> dropped
    ])
    raw = read_raw_csv(spark, path)
    out = clean.clean(raw).orderBy("timestamp").collect()
    assert len(out) == 2
    first, second = out
    assert first.timestamp == dt.datetime(2006, 12, 16, 17, 24)
    assert second.timestamp == dt.datetime(2007, 2, 1, 0, 0)
    assert second.active_power == 0.0 and second.Sub_metering_3 == 0.0
    assert second.Voltage == 230.0
    # mean of the present values (only one row has them)
    assert second.current == 18.4 and second.reactive_power == 0.418


def test_aliases_and_index_column(spark):
    df = spark.createDataFrame(
        [("0", "16/12/2006", "17:24:00", "1.5", "0.1", "240", "6.2", "1", "2", "3")],
        "_c0 string, date string, time string, active_power string, reactive_power string, "
        "voltage string, intensity string, sub_metering1 string, submetering_2 string, "
        "sub_metering3 string")
    out = clean.clean(df).collect()[0]
    assert out.active_power == 1.5 and out.Voltage == 240.0 and out.current == 6.2
    assert out.Sub_metering_1 == 1.0 and out.Sub_metering_2 == 2.0 and out.Sub_metering_3 == 3.0


def test_missing_column_becomes_zero(spark):
    df = spark.createDataFrame([("16/12/2006", "17:24:00", "1.5")],
                               "Date string, Time string, Global_active_power string")
    out = clean.clean(df).collect()[0]
    assert out.Sub_metering_2 == 0.0 and out.Voltage == 0.0


def test_nan_is_missing_and_mean_ignores_it(spark):
    df = spark.createDataFrame(
        [("16/12/2006", "17:24:00", 1.0, 0.2, float("nan"), 2.0, 0.0, 0.0, 0.0),
         ("16/12/2006", "17:25:00", float("nan"), 0.4, 230.0, float("nan"), 0.0, 0.0, 0.0)],
        "Date string, Time string, Global_active_power double, Global_reactive_power double, "
        "Voltage double, Global_intensity double, Sub_metering_1 double, Sub_metering_2 double, "
        "Sub_metering_3 double")
    out = clean.clean(df).orderBy("timestamp").collect()
    assert out[0].Voltage == 230.0
    assert out[1].active_power == 0.0
    assert out[1].current == 2.0


def test_dense_index_and_imputation(spark):
    rows = [(i, None if i in (0, 3, 7) else f"16/12/2006 10:{i:02d}:00") for i in range(10)]
    df = spark.createDataFrame(rows, "id long, ts string").select(
        "id", F.try_to_timestamp("ts", F.lit("d/M/yyyy HH:mm:ss")).cast("timestamp_ntz").alias("timestamp"))
    out = {r.id: r for r in clean.impute_timestamps(df, "id", step_minutes=1).collect()}
    assert [out[i].row_index for i in range(10)] == list(range(10))
    # anchor = row 1 (10:01); row 0 is one step before, rows 3 and 7 after
    assert out[0].timestamp == dt.datetime(2006, 12, 16, 10, 0)
    assert out[3].timestamp == dt.datetime(2006, 12, 16, 10, 3)
    assert out[7].timestamp == dt.datetime(2006, 12, 16, 10, 7)
    assert out[0].was_imputed and not out[1].was_imputed


def test_dense_index_many_partitions(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "k").repartition(13)
    idx = clean.dense_index(df, "k").orderBy("k").collect()
    assert [r.row_index for r in idx] == list(range(len(idx)))


def test_dense_index_null_tied_large_and_text_keys(spark):
    rows = [(None if i % 5 == 0 else i // 7, (1 << 60) + i, f"k{i:04d}", i) for i in range(900)]
    rows += [rows[3]] * 20
    for parts in (1, 6):
        df = spark.createDataFrame(rows, "tied long, large long, word string, id long").repartition(parts)
        tied = clean.dense_index(df, "tied", tie_breaker=("id",)).collect()
        assert len(tied) == len(rows)
        order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[3]))
        assert [r.id for r in sorted(tied, key=lambda r: r.row_index)] == [r[3] for r in order]
        for key in ("large", "word"):
            got = sorted(clean.dense_index(df, key).collect(), key=lambda r: r.row_index)
            assert [r.row_index for r in got] == list(range(len(rows)))
            assert [r.id for r in got] == sorted(r[3] for r in rows)


def test_clean_keeps_rows_without_key(spark):
    rows = [(i if i % 3 else None, "16/12/2006" if i != 4 else "", f"10:{i % 60:02d}:00") for i in range(90)]
    df = spark.createDataFrame(rows, "k long, Date string, Time string")
    out = clean.clean(df, order_by="k", impute_step_minutes=1).collect()
    assert len(out) == 90 and all(r.timestamp is not None for r in out)


def _ingest_lines(days):
    return [HEADER] + [f"{d},10:00:00,1.0,0.1,240,4,1,2,3" for d in days]


def test_default_ingest_in_file_order(spark, tmp_dir):
    """No order column: rows are counted file by file, in file order."""
    _write(tmp_dir, _ingest_lines(["", "1/1/2007", "", "1/3/2007"]), "b.csv")
    one = jobs.ingest(spark, f"{tmp_dir}/b.csv", f"{tmp_dir}/one", f"{tmp_dir}/stats")
    assert sorted(str(r.timestamp) for r in one.collect()) == [
        "2007-01-01 09:59:00", "2007-01-01 10:00:00", "2007-01-01 10:01:00", "2007-03-01 10:00:00"]
    folder = os.path.join(tmp_dir, "many")
    os.mkdir(folder)
    _write(folder, _ingest_lines(["", ""] * 20), "a.csv")
    _write(folder, _ingest_lines(["", "", "5/5/2007"] + [""] * 400), "b.csv")
    _write(folder, _ingest_lines(["", "6/6/2007"]), "c.csv")
    many = jobs.ingest(spark, folder, f"{tmp_dir}/out").collect()
    anchor = dt.datetime(2007, 5, 5, 10, 0)     # row 42 of all
    expected = [anchor + dt.timedelta(minutes=i - 42) for i in range(445)]
    expected[-1] = dt.datetime(2007, 6, 6, 10, 0)
    assert sorted(r.timestamp for r in many) == sorted(expected)


def test_small_splits_do_not_change_file_order(spark, tmp_dir):
    path = _write(tmp_dir, _ingest_lines(["5/5/2007"] + [""] * 600))
    key = "spark.sql.files.maxPartitionBytes"
    saved = spark.conf.get(key)
    try:
        spark.conf.set(key, "2048")
        raw = clean.with_file_position(read_raw_csv(spark, path))
        assert raw.rdd.getNumPartitions() > 4
        out = clean.impute_timestamps(clean.typed_readings(raw, clean.FILE_POSITION), None)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.row_index for r in out.collect()) == list(range(601))
        start = dt.datetime(2007, 5, 5, 10, 0)
        assert sorted(r.timestamp for r in out.collect()) == [start + dt.timedelta(minutes=i) for i in range(601)]
        assert "rangepartitioning" not in plan      # no row is moved to be numbered
    finally:
        spark.conf.set(key, saved)


def test_ingest_of_an_empty_export_is_refused(spark, tmp_dir):
    path = _write(tmp_dir, [HEADER])
    with pytest.raises(ValueError, match="no readings"):
        jobs.ingest(spark, path, f"{tmp_dir}/none")


def test_command_line_ingest(spark, tmp_dir, monkeypatch, capsys):
    from meterlake import __main__ as cli
    _write(tmp_dir, _ingest_lines(["1/1/2007", ""]))
    monkeypatch.setattr(cli, "get_session", lambda *a, **k: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    assert cli.main(["ingest", f"{tmp_dir}/raw.csv", f"{tmp_dir}/out"]) == 0
    assert '"rows": 2' in capsys.readouterr().out


def test_imputation_without_any_valid_timestamp(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, timestamp timestamp_ntz")
    out = clean.impute_timestamps(df, "id").orderBy("id").collect()
    assert out[0].timestamp == dt.datetime(2006, 12, 16, 17, 24)
    assert out[1].timestamp == dt.datetime(2006, 12, 16, 17, 25)


def test_bucket_index_equals_dense_index(spark, monkeypatch):
    """Unique keys, NULL and tied keys, a hot key, and rows that are equal throughout;
    no copy of the table is written unless equal rows fill a bucket."""
    sorted_copies = []
    by_sort = clean.dense_index
    monkeypatch.setattr(clean, "dense_index", lambda *a, **k: sorted_copies.append(1) or by_sort(*a, **k))
    n = 3000
    tables = {"unique": [(i * 7919 % n, float(i)) for i in range(n)],
              "tied": [(None if i % 5 == 0 else i // 9, float(i)) for i in range(n)],
              "hot": [(1 if i % 2 else i, -float(i)) for i in range(n)],
              "one": [(1, 2.0)], "none": [],
              "equal": [(1, 2.0)] * n + [(2, None), (None, 1.0)]}
    for name, rows in tables.items():
        df = spark.createDataFrame(rows, "k long, v double").repartition(3)
        got = sorted(clean.bucket_index(df, "k", buckets=8).collect(), key=lambda r: r.row_index)
        order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0))
        assert [r.row_index for r in got] == list(range(len(rows)))
        assert [(r.k, r.v) for r in got] == order
        assert len(sorted_copies) == (1 if name == "equal" else 0)


def test_anchor_among_tied_keys(spark):
    """The first valid time among rows that share the smallest key, by the tie breaker."""
    t = [None, dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 3, 0, 0, 123456)]
    rows = [(None, 0, t[1]), (1, 5, t[2]), (1, 2, t[1]), (1, 1, t[0]), (0, 9, t[0])]
    df = spark.createDataFrame(rows, "k long, id long, timestamp timestamp_ntz")
    for df, want in ((df, {9: 3, 1: 4, 2: 5}), (df.filter("id in (5, 9, 1)"), {9: 1, 1: 2})):
        out = {r.id: r for r in clean.impute_timestamps(df, "k", step_minutes=60).collect()}
        assert {i: out[i].timestamp.hour for i in want} == want
    assert out[9].timestamp.microsecond == 123456
    unique = spark.createDataFrame([(3, t[2]), (1, None), (7, t[1])], "k long, timestamp timestamp_ntz")
    out = {r.k: r.timestamp for r in clean.impute_timestamps(unique, "k", step_minutes=60).collect()}
    assert out[1] == dt.datetime(2024, 1, 1, 2, 0, 0, 123456)
