"""Folders of CSV files with differing headers and damaged files."""

import gzip

import pytest

from signalframe.sources import folders


def names_of(outcomes, value):
    return {r.file.rsplit("/", 1)[-1]: r.reason for r in outcomes.collect() if r.outcome == value}


def test_many_files_cost_one_scan_a_header(spark, tmp_path):
    headers = ["a,b", "b,c", "c,a,d"]
    for k in range(500):
        header = headers[k % 3]
        cells = ",".join(f"{n}{k}" for n in header.split(","))
        (tmp_path / f"batch {k}+[{k % 7}]%20.csv").write_text(f"{header}\n{cells}\n", encoding="utf-8")
    found, outcomes = folders.scan_csv_folder(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3
    rows = {(r.a, r.b, r.c, r.d) for r in found.collect()}
    assert len(rows) == 500 and ("a0", "b0", None, None) in rows and ("a2", None, "c2", "d2") in rows
    assert outcomes.where("outcome = 'read' and records = 1").count() == 500


def test_damaged_files_are_left_out_whole_and_listed(spark, tmp_path):
    good = "t,n\n" + "".join(f"2024-01-01 00:00:{k:02d},{k}\n" for k in range(50))
    (tmp_path / "good.csv").write_text(good, encoding="utf-8")
    (tmp_path / "quoted.csv").write_text('t,n\r\n"2024-01-02 00:00:00","a ""b"", c"\r\n5" pipe,\r\n\r\n', encoding="utf-8")
    (tmp_path / "whole.csv.gz").write_bytes(gzip.compress(good.encode()) + gzip.compress(b"2024-01-01 00:01:00,50\n"))
    import random
    noise = "t,n\n" + "".join(f"2024-01-01 00:00:00,{random.Random(k).random()}\n" for k in range(20_000))
    (tmp_path / "cut.csv.gz").write_bytes(gzip.compress(noise.encode())[:-9_000])
    (tmp_path / "wide.csv").write_text("t,n\n1,2\n1,2,3\n", encoding="utf-8")
    (tmp_path / "open.csv").write_text('t,n\n1,2\n1,"2\n', encoding="utf-8")
    (tmp_path / "bytes.csv").write_bytes(b"t,n\n1,\xff\xfe\n")
    (tmp_path / "none.csv").write_bytes(b"\n")
    (tmp_path / "head.csv").write_text("t,n,more", encoding="utf-8")
    found, outcomes = folders.scan_csv_folder(spark, str(tmp_path), "t timestamp_ntz, n int, late string")
    assert names_of(outcomes, "skipped") == {
        "cut.csv.gz": "gzip breaks off", "wide.csv": "more cells than the header", "open.csv": "quoted cell without end", "bytes.csv": "not UTF-8"}
    assert set(names_of(outcomes, "empty")) == {"none.csv"}
    assert {r.file.rsplit("/", 1)[-1]: r.records for r in outcomes.where("outcome = 'read'").collect()} == {
        "good.csv": 50, "quoted.csv": 2, "whole.csv.gz": 51, "head.csv": 0}
    assert found.count() == 103 and set(found.columns) == {"t", "n", "late", "more"}
    assert found.agg({"n": "sum"}).first()[0] == 2 * sum(range(50)) + 50
    assert found.where("late is not null or more is not null").count() == 0


def test_nothing_whole_gives_no_rows(spark, tmp_path):
    (tmp_path / "none.csv").write_bytes(b"\n")
    found, outcomes = folders.scan_csv_folder(spark, str(tmp_path), "n int")
    assert found.columns == ["n"] and found.count() == 0 and outcomes.first().outcome == "empty"


@pytest.mark.parametrize("header, names", [
    ('a,"b,c",A', ["a", "b,c", "A.1"]), (",x,", ["_c0", "x", "_c2"]), ("a,a,a.1", ["a", "a.1", "a.1.1"]),
])
def test_header_names(header, names):
    assert folders.header_names(header) == names


def test_gzip_ends():
    one, two = gzip.compress(b"x" * 9_000_000), gzip.compress(b"y")
    assert folders.gzip_ends(one) and folders.gzip_ends(one + two) and folders.gzip_ends(one + b"\0\0")
    assert not folders.gzip_ends(one[:-1]) and not folders.gzip_ends(one + two[:-3]) and not folders.gzip_ends(b"") and not folders.gzip_ends(b"text")
