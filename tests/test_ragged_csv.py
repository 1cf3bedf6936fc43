import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from dosecast.functions import csv_text
from dosecast.sources import ragged_csv
from dosecast.sources.ragged_csv import read_ragged_csv


def read(spark, folder, **kw):
    """{file name: (header, [cells], error)}"""
    out = {}
    records = read_ragged_csv(spark, [str(folder)], **kw)
    rows = records.select("path", "header", "line_no", "error", csv_text.cells(F.col("record")).alias("cells"))
    for r in sorted(rows.collect(), key=lambda r: r["line_no"] or 0):
        name = r["path"].rsplit("/", 1)[1]
        entry = out.setdefault(name, (r["header"], [], r["error"]))
        if r["cells"] is not None:
            entry[1].append(r["cells"])
    return out


def put(folder, name, text):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode("utf-8"))
    return path


def test_header_after_junk_lines(spark, tmp_path):
    put(tmp_path, "a.csv", ",,\n,x,\nSite,Country,Subject\n101,USA,12345\n\n102,Canada,12346\n")
    header, rows, error = read(spark, tmp_path)["a.csv"]
    assert (header, error) == (["Site", "Country", "Subject"], None)
    assert rows == [["101", "USA", "12345"], ["102", "Canada", "12346"]]


def test_failing_files_do_not_stop_others(spark, tmp_path):
    put(tmp_path, "late.csv", ",,\n" * 15 + "a,b\n1,2\n")
    put(tmp_path, "tenth.csv", ",,\n" * 9 + "a,b\n1,2\n")
    put(tmp_path, "none.csv", "only one cell\n")
    put(tmp_path, "long.csv", "a,b\n1,2\n1,2,3\n")
    put(tmp_path, "open.csv", 'a,b\n1,"2\n3,4\n')
    put(tmp_path, "latin.csv", b"a,b\n1,caf\xe9\n")
    put(tmp_path, "good.csv", "a,b\n1,2\n3\n")
    got = read(spark, tmp_path)
    errors = {name: error for name, (_, _, error) in got.items()}
    assert errors == {
        "late.csv": ragged_csv.NO_HEADER,
        "none.csv": ragged_csv.NO_HEADER,
        "long.csv": ragged_csv.LONG_ROW,
        "open.csv": ragged_csv.OPEN_QUOTE,
        "latin.csv": ragged_csv.BAD_TEXT,
        "tenth.csv": None,
        "good.csv": None,
    }
    assert got["tenth.csv"][1] == [["1", "2"]]
    assert got["good.csv"][1] == [["1", "2"], ["3"]]


QUOTED = 'p,q\n"Capsule 150mg, 60 ct.",1\n"say ""hi""",\n5" tube,x"y\n"a"b,"",\n'


def test_quotes(spark, tmp_path):
    put(tmp_path, "q.csv", QUOTED.replace('"a"b,"",\n', '"a"b,""\n'))
    _, rows, error = read(spark, tmp_path)["q.csv"]
    assert error is None
    assert rows == [["Capsule 150mg, 60 ct.", "1"], ['say "hi"', ""], ['5" tube', 'x"y'], ["ab", ""]]


def random_table(rng, n):
    words = ["", "plain", "a,b", 'q"q', "line\nbreak", "two\n\nbreaks, and comma", '"', '""', ',"', "\n", "x\ny\nz", "é"]
    return [[rng.choice(words), str(i), rng.choice(words)] for i in range(n)]


def written(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("way", ["whole", "split", "tiny splits"])
def test_line_breaks_in_cells_against_csv_module(spark, tmp_path, way):
    rng = random.Random(7)
    tables = {f"t{i}.csv": random_table(rng, 40) for i in range(4)}
    tables["plain.csv"] = [[str(i), "v", "w"] for i in range(50)]
    for name, rows in tables.items():
        put(tmp_path, name, ",,\n" + written([["h1", "h2", "h3"], *rows], "\r\n" if name == "t3.csv" else "\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        if way == "tiny splits":
            spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
            spark.conf.set("spark.sql.files.openCostInBytes", "10")
        got = read(spark, tmp_path, **({} if way == "whole" else {"whole_bytes": 0}))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    for name, rows in tables.items():
        assert got[name][2] is None, name
        assert got[name][1] == rows, name


@pytest.mark.parametrize("way", ["whole", "split"])
def test_every_line_end_counts_and_headers_alone_are_files(spark, tmp_path, way):
    put(tmp_path, "cr.csv", "junk\rDepot ID,Country\r1,X\r2,Y\r")
    put(tmp_path, "mixed.csv", "a,b\r\n1,2\r3,4\n5,6")
    put(tmp_path, "in cell.csv", 'a,b\r1,"x\ry"\r\n"p\r\nq",2\r')
    put(tmp_path, "head.csv", "a,b\n")
    put(tmp_path, "bare head.csv", "a,b")
    put(tmp_path, "open.csv", 'a,b\r1,"2\r3,4\r')
    got = read(spark, tmp_path, **({} if way == "whole" else {"whole_bytes": 0}))
    assert got["cr.csv"] == (["Depot ID", "Country"], [["1", "X"], ["2", "Y"]], None)
    assert got["mixed.csv"] == (["a", "b"], [["1", "2"], ["3", "4"], ["5", "6"]], None)
    assert got["in cell.csv"] == (["a", "b"], [["1", "x\ry"], ["p\r\nq", "2"]], None)
    assert got["head.csv"] == got["bare head.csv"] == (["a", "b"], [], None)
    assert got["open.csv"][1:] == ([], ragged_csv.OPEN_QUOTE)


def test_split_way_reports_the_same_errors(spark, tmp_path):
    put(tmp_path, "late.csv", ",,\n" * 15 + "a,b\n1,2\n")
    put(tmp_path, "none.csv", "only one cell\n")
    put(tmp_path, "long.csv", "a,b\n1,2\n1,2,3\n")
    put(tmp_path, "open.csv", 'a,b\n1,"2\n3,4\n')
    put(tmp_path, "latin.csv", b"a,b\n1,caf\xe9\n")
    put(tmp_path, "wide junk.csv", ",,,,,\na,b\n1,2\n")
    whole = {k: v[2] for k, v in read(spark, tmp_path).items()}
    split = {k: v[2] for k, v in read(spark, tmp_path, whole_bytes=0).items()}
    assert whole == split
    assert whole["wide junk.csv"] is None


@pytest.mark.parametrize("few", [1000, 0])
def test_only_chosen_files(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(ragged_csv, "FEW_FILES", few)
    kept = put(tmp_path, "a b+c%.csv", "x,y\n1,2\n")
    put(tmp_path, "other.csv", "x,y\n3,4\n")
    chosen = spark.createDataFrame([(f"file:{kept}",)], "path string")
    assert list(read(spark, tmp_path, chosen=chosen)) == [os.path.basename(kept)]
    assert list(read(spark, tmp_path, chosen=chosen, whole_bytes=0)) == [os.path.basename(kept)]
