import json
import os

import pytest

from meterlake import jobs
from meterlake.plans import joins
from meterlake.sources import exports


def _write(folder, name, lines, end="\n"):
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(end.join(lines) + end if lines else "")


def _folder(tmp_dir):
    _write(tmp_dir, "a.csv", ["Date,Time,Voltage", "1/1/2024,00:00:00,230", "", "2/1/2024,00:00:00,?",
                              '3/1/2024,"0,0",1', "4/1/2024,00:00:00", "5/1/2024,00:00:00,1,2", '6/1/2024,"x,1'])
    # decimal commas inside, another column order, a byte order mark, a repeated header
    _write(tmp_dir, "b.csv", ["\ufeffVoltage;Date;Time", "230,5;1/1/2024;00:01:00", "\ufeffVoltage;Date;Time", ";2/1/2024;"],
           end="\r\n")
    _write(tmp_dir, "c.tsv", ['Date\t"Extra, name"\tTime', "1/1/2024\tq;r\t00:02:00"])
    _write(tmp_dir, "d.csv", ["Date"] + ["7/1/2024"] * 3)       # a single column
    _write(tmp_dir, "e.csv", [])
    _write(tmp_dir, "f.csv", ["Date|Time"])                     # a header alone
    return tmp_dir


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_every_file_by_its_own_dialect(spark, tmp_dir, monkeypatch, limit):
    monkeypatch.setattr(exports, "BROADCAST_BYTES", limit)
    rows, rejects = exports.read_exports(spark, _folder(tmp_dir))
    assert set(rows.columns) == {"Date", "Time", "Voltage", "Extra, name", "_file", "_block", "_row"}
    got = {(os.path.basename(r["_file"]), r["Date"], r["Time"], r["Voltage"], r["Extra, name"]) for r in rows.collect()}
    assert got == {("a.csv", "1/1/2024", "00:00:00", "230", None), ("a.csv", "2/1/2024", "00:00:00", None, None),
                   ("a.csv", "3/1/2024", "0,0", "1", None),
                   ("b.csv", "1/1/2024", "00:01:00", "230,5", None), ("b.csv", "2/1/2024", None, None, None),
                   ("c.tsv", "1/1/2024", "00:02:00", None, "q;r"), ("d.csv", "7/1/2024", None, None, None)}
    assert rows.filter("Date = '7/1/2024'").count() == 3
    bad = {(os.path.basename(r["file"]), r["reason"], r["line"]) for r in rejects.collect()}
    assert bad == {("a.csv", "short", "4/1/2024,00:00:00"), ("a.csv", "long", "5/1/2024,00:00:00,1,2"),
                   ("a.csv", "quote", '6/1/2024,"x,1')}


def test_ingest_of_mixed_exports(spark, tmp_dir):
    """Rows of all dialects in one clean table, timestamps imputed in file order over
    the readable rows, rejects beside it."""
    os.mkdir(f"{tmp_dir}/in")
    _write(f"{tmp_dir}/in", "a.csv", ["Date,Time,Voltage", "1/1/2024,00:00:00,230", "bad", ",,231"])
    _write(f"{tmp_dir}/in", "b.csv", ["Voltage;Time;Date", "232;;", "233;00:09:00;1/1/2024"])
    out = jobs.ingest(spark, f"{tmp_dir}/in", f"{tmp_dir}/clean", sep="auto", rejects_path=f"{tmp_dir}/rejects")
    got = {r["Voltage"]: r["timestamp"].strftime("%H:%M") for r in out.collect()}
    assert got == {230.0: "00:00", 231.0: "00:01", 232.0: "00:02", 233.0: "00:09"}
    bad = [json.loads(x) for f in os.listdir(f"{tmp_dir}/rejects") if f.endswith(".json")
           for x in open(f"{tmp_dir}/rejects/{f}")]
    assert [(b["reason"], b["line"]) for b in bad] == [("short", "bad")]
    with pytest.raises(ValueError):
        os.mkdir(f"{tmp_dir}/none")
        _write(f"{tmp_dir}/none", "x.csv", ["Date,Time"])
        jobs.ingest(spark, f"{tmp_dir}/none", f"{tmp_dir}/no", sep="auto")
