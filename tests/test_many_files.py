"""Trees of more files than the driver is to hold."""

import datetime as dt
import weakref
from pathlib import Path

import pytest
from pyspark.sql import DataFrameReader

from dosecast.plans import curate
from dosecast.sources import discovery, ragged_csv, staging

HEADER = "Country,Site ID,Comparator Name,Site Level Supply Method,Site Status"
ODD = ["a b", "50%", "[a]", "{b,c}", "q?*", "back\\slash", "_part=1"]


@pytest.fixture
def tree(tmp_path):
    """A date folder of 9 study folders: every third file has a line break in a cell, every third a quote never closed."""
    root = tmp_path / "raw"
    for i in range(9):
        folder = root / "20240201" / (ODD[i] if i < len(ODD) else f"folder {i}")
        folder.mkdir(parents=True)
        cell = ("plain", '"two\nlines"', '"open')[i % 3]
        (folder / f"AA-BB-{i}-1 Site SupplyMethod {ODD[i % 7]}.csv").write_text(f"{HEADER}\nLand,{i},{cell},central,Open\n")
        (folder / f"_AA-BB-{i}-1 Site SupplyMethod hidden.csv").write_text(f"{HEADER}\nLand,hidden,x,central,Open\n")
    for hidden in (".hidden", "_hidden"):
        (root / "20240201" / hidden).mkdir()
        (root / "20240201" / hidden / "AA-BB-9-1 Site SupplyMethod.csv").write_text(f"{HEADER}\nLand,hidden,x,central,Open\n")
    return str(root)


def test_no_reader_holds_more_than_a_group_of_files(spark, tree, monkeypatch):
    monkeypatch.setattr(discovery, "GROUP_FILES", 4, raising=False)
    monkeypatch.setattr(ragged_csv, "FEW_FILES", 1)
    held = []

    def watched(read):
        def call(*args, **kw):
            df = read(*args, **kw)
            held.append(len(df.inputFiles()))
            return df

        return call

    for owner, name in ((DataFrameReader, "load"), (DataFrameReader, "text"), (discovery, "load_group")):
        if hasattr(owner, name):
            monkeypatch.setattr(owner, name, watched(getattr(owner, name)))
    settings = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.hive.manageFilesourcePartitions")
    before = [spark.conf.get(key) for key in settings]
    params = curate.CurationParams(tree, r"AA-BB-\d+-\d+", dt.datetime(2024, 3, 1))
    curated = curate.curate_kind(spark, "site_supply", params)
    assert sorted((int(r["site_id"]), r["comparator_name"]) for r in curated.rows.collect()) == [
        (i, ("plain", "two\nlines")[i % 3]) for i in range(9) if i % 3 < 2
    ]
    assert [r["error"] for r in curated.rejected.collect()] == [ragged_csv.OPEN_QUOTE] * 3
    assert max(held) <= 4 and sum(held) >= 9 + 9 + 6
    assert [spark.conf.get(key) for key in settings] == before


def test_groups_cover_every_file_once(spark, tree, monkeypatch):
    (Path(tree) / "20240201" / "line\nfeed.csv").write_text("a,b\n")
    whole = {r["path"] for r in discovery.list_files(spark, tree + "/20240201").collect()}
    assert len(whole) == 10
    monkeypatch.setattr(discovery, "GROUP_FILES", 5)
    listed = discovery.list_files(spark, tree + "/20240201")
    assert sorted(r["path"] for r in listed.collect()) == sorted(whole)
    groups = [g for g, _ in discovery.file_groups(listed.unionByName(listed))]
    assert sorted(p for g in groups for p in g) == sorted(discovery.exactly(p) for p in whole)
    assert max(map(len, groups)) <= 5


def test_tasks_of_a_group_follow_files_and_bytes(spark, monkeypatch):
    monkeypatch.setattr(discovery, "GROUP_FILES", 2000)
    small = spark.range(2000).selectExpr("cast(id as string) AS path", "10L AS length")
    big = spark.range(3).selectExpr("cast(id as string) AS path", "1073741824L AS length")
    assert [n for _, n in discovery.file_groups(small)] == [8]
    assert [n for _, n in discovery.file_groups(big)] == [24]
    assert [n for _, n in discovery.file_groups(big.select("path"))] == [3]


def test_written_frames_are_let_go(spark):
    proxies = []

    def made(n):
        df = spark.range(n).select("id")
        proxies.append(weakref.ref(df._jdf))
        return df

    def frames():
        for n in (2, 3):
            assert all(proxy() is None for proxy in proxies)
            yield made(n)

    assert sorted(r["id"] for r in staging.stage_all(frames(), "frames").collect()) == [0, 0, 1, 1, 2]
