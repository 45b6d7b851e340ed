"""Files with awkward names and headers, large files, JSON whose types drift, loads that fail."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeward.sources import files, tables
from lakeward.streaming import steps

GLOB = files.FILE_GLOBS["cars"]


def ts():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def bytes_read_by_jvm():
    """Bytes that the JVM of this process has read so far, from files and pipes alike."""
    total = 0
    for status in Path("/proc").glob("[0-9]*/status"):
        try:
            parent = int(status.read_text().split("PPid:")[1].split()[0])
            if parent == os.getpid() and "java" in status.read_text().splitlines()[0]:
                total += int((status.parent / "io").read_text().split("rchar: ")[1].split()[0])
        except (OSError, IndexError):
            pass
    return total


def test_names_that_urls_escape_and_headers_over_lines(spark, tmp_path):
    landing, bronze = tmp_path / "in dir", str(tmp_path / "bronze")
    names = ["cars a.csv", "cars%20b.csv", "cars#c é.csv", "cars[d]{e}?*.csv", "cars+f=g.csv"]
    for n, name in enumerate(names):
        write(landing / "p=1" / name, f"car_id,name\n{n},x\n")
    write(landing / "cars_lines.csv", '\n"car\n_id",name\n"8","y\nz"\n9,w\n')
    write(landing / "cars_inch.csv", 'car_id,5" wheel\n10,q\n')
    loads = lambda: files.ingest_csv(spark, str(landing), GLOB, bronze, ts())
    assert loads() == 7 and loads() == 0
    rows = [r.asDict() for r in files.read_bronze(spark, bronze).collect()]
    assert sorted(r["car_id"] for r in rows if r["car_id"]) == ["0", "1", "10", "2", "3", "4"]
    assert {(r["car\n_id"], r["name"]) for r in rows if r["car\n_id"]} == {("8", "y\nz"), ("9", "w")}
    assert [r['5" wheel'] for r in rows if r["car_id"] == "10"] == ["q"]
    assert all(r["_rescued_data"] is None for r in rows)
    named = {r["car_id"]: r["_source_file"] for r in rows}
    assert named["1"].endswith("cars%2520b.csv") and named["0"].endswith("cars%20a.csv")


@pytest.mark.parametrize(
    ("lines", "header"),
    [
        (["", "a,b", "1,2"], "a,b"),
        (['"a', 'x",b', "1,2"], '"a\nx",b'),
        (['a,"b""', 'c",d', "1"], 'a,"b""\nc",d'),
        (['5" disk,b', "1,2"], '5" disk,b'),
        (['"never closed', "1,2"], '"never closed'),
        ([" ", ""], None),
    ],
)
def test_first_record(lines, header):
    assert files._first_record(iter(lines), ",") == header


def test_the_probe_of_large_files_reads_less_than_a_megabyte_each(spark, tmp_path):
    row = "x" * 200 + ",1\n"
    for n in range(3):
        write(tmp_path / f"cars{n}.csv", f"a{n},b\n" + row * 100_000)
    listed = files.list_files(spark, str(tmp_path), GLOB).collect()
    files.probe_headers(spark, listed)
    before = bytes_read_by_jvm()
    found = files.probe_headers(spark, listed)
    assert before and bytes_read_by_jvm() - before < 3 << 20
    assert sorted(found.values()) == ["a0,b", "a1,b", "a2,b"]


def test_headers_of_large_files_far_down_or_over_many_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PROBE_BYTES", 100)
    monkeypatch.setattr(files, "PROBE_LINES", 2)
    rows = "1,2\n" * 100
    write(tmp_path / "cars1.csv", "\n" * 90 + "a,b\n" + rows)
    write(tmp_path / "cars2.csv", '"a\n' + "x\n" * 50 + '",b\n' + rows)
    write(tmp_path / "cars3.csv", '"a,b\n' + rows)
    write(tmp_path / "cars4.csv", "\n" * 300)
    found = files.probe_headers(spark, files.list_files(spark, str(tmp_path), GLOB))
    own = {path[-5]: header for path, header in found.items()}
    assert own == {"1": "a,b", "2": '"a\n' + "x\n" * 50 + '",b', "3": '"a,b'}


def test_a_load_that_failed_before_its_ledger_is_written_anew(spark, tmp_path, monkeypatch):
    landing, bronze = tmp_path / "in", str(tmp_path / "bronze")
    for n in range(3):
        write(landing / f"cars{n}.csv", f"car_id\n{n}\n")
    loads = lambda: files.ingest_csv(spark, str(landing), GLOB, bronze, ts(), files_per_load=2)
    real = files.write_load

    def failing(rows, path, load):
        if load == 2 and path.endswith(files.LEDGER):
            raise OSError("lost")
        real(rows, path, load)

    monkeypatch.setattr(files, "write_load", failing)
    with pytest.raises(OSError):
        loads()
    assert files.read_bronze(spark, bronze).count() == 3
    monkeypatch.setattr(files, "write_load", real)
    write(landing / "cars3.csv", "car_id,name\n3,new\n")
    assert loads() == 2 and loads() == 0
    assert sorted(r["car_id"] for r in files.read_bronze(spark, bronze).collect()) == list("0123")


def test_json_types_drift_between_loads(spark, tmp_path):
    landing, bronze = tmp_path / "in", str(tmp_path / "bronze")
    load = lambda: files.ingest_json(
        spark, str(landing), "claims*.json", bronze, ["ClaimID", "place", "a.b"], ts()
    )
    write(landing / "claims 1.json", '[{"ClaimID": "a", "place": {"city": "x", "no": [1, 2]}, "more": {"z": 2.5}}]')
    assert load() == 1
    write(landing / "claims 2.json", '[{"ClaimID": 7, "place": "text", "a.b": true, "more": "m", "None": null},\n {}]')
    write(landing / "claims 3.json", "[]")
    write(landing / "claims 4.json", " \n")
    write(landing / "claims 5.json", '[{"ClaimID": "c"}, 5]')
    assert load() == 4
    table = files.read_bronze(spark, bronze)
    rows = {r["ClaimID"]: r for r in table.where("ClaimID IS NOT NULL").collect()}
    assert set(rows) == {"a", "7"} and table.count() == 4
    assert json.loads(rows["a"]["place"]) == {"city": "x", "no": [1, 2]}
    assert (rows["7"]["place"], rows["7"]["a.b"]) == ("text", "true")
    more = table.select("ClaimID", files.rescued("more").alias("more"), files.rescued("more", "int").alias("n"))
    assert {r["ClaimID"]: r["more"] for r in more.collect() if r["ClaimID"]} == {"a": '{"z":2.5}', "7": "m"}
    broken = [r["_rescued_data"] for r in table.where("ClaimID IS NULL").collect()]
    assert [json.loads(b) for b in broken if b] == [{"_broken": '[{"ClaimID": "c"}, 5]'}]


def test_streams_rescue_undeclared_keys(spark, tmp_path):
    write(tmp_path / "in" / "a.json", '{"k": "1", "other": {"x": 1}}\nbroken\n{"k": {"y": 2}}\n')
    step = steps.Step(
        "json",
        lambda s: steps.stream_json(s, str(tmp_path / "in"), "k string", "*.json", ts(), multi_line=False),
        str(tmp_path / "out"),
    )
    steps.run_step(spark, step, str(tmp_path / "ck"))
    table = tables.optional_path(spark, str(tmp_path / "out"))
    assert {(r["k"], r["_rescued_data"]) for r in table.collect()} == {
        ("1", '{"other":{"x":1}}'), (None, '{"_broken":"broken"}'), ('{"y":2}', None)
    }
    assert table.select(files.rescued("other.x")).distinct().collect() == [(None,)]
