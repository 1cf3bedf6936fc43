import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dosecast.fixed_values import FORECAST_SCHEMA, headers, SITE_SUPPLY_HEADERS, SUBJECT_HEADERS
from dosecast.operators import conform, quality
from dosecast.plans import curate
from dosecast.sources import discovery, sinks, tables
from dosecast.sources.discovery import FolderChoice

PATTERN = r"AA-BB-\d+-\d+"
SUPPLY = ",".join(h for _, h, _ in headers(SITE_SUPPLY_HEADERS))
NAMES = [h for _, h, _ in headers(SUBJECT_HEADERS)]


def put(root, path, text, age=0):
    file = root / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(text)
    os.utime(file, (1_700_000_000 - age, 1_700_000_000 - age))


def params(root, **kw):
    return curate.CurationParams(str(root), PATTERN, dt.datetime(2025, 1, 2, 3), **kw)


def mapping(spark, **sources):
    """Header mapping; by default each study names its columns ``<study> <header>``."""
    columns = ["Column Header", *sources]
    rows = [(h, *[make(h) for make in sources.values()]) for h in NAMES]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def supply(country, site="1"):
    return f"{SUPPLY}\n{country},{site},Comp,central,Open\n"


def test_folder_choice_and_latest_version(spark, tmp_path):
    name = "Acme AA-BB-1-1 Site SupplyMethod"
    put(tmp_path, f"20250101/study 1/{name}.csv", supply("old day"))
    put(tmp_path, f"20250201/study 1/{name} v1.csv", supply("v1"), age=50)
    put(tmp_path, f"20250201/study 1/{name} v2.CSV", supply("v2"), age=10)
    put(tmp_path, f"20250201/study 2/{name} a.csv", supply("tie a"), age=10)
    put(tmp_path, f"20250201/study 2/{name} b.csv", supply("tie b"), age=10)
    put(tmp_path, f"20250201/{name}.csv", supply("folder root"))
    put(tmp_path, f"20259999/study 1/{name}.csv", supply("no date"))
    put(tmp_path, f"archive/study 1/{name}.csv", supply("no folder"))

    def countries(**kw):
        rows = curate.curate_kind(spark, "site_supply", params(tmp_path, **kw)).rows
        return {r["country"] for r in rows.collect()}

    assert countries() == {"v2", "tie a"}
    assert countries(latest_only=False) == {"v1", "v2", "tie a", "tie b", "folder root"}
    assert countries(choice=FolderChoice(True)) == {"old day", "v2", "tie a"}
    assert countries(choice=FolderChoice(True, end=dt.date(2025, 1, 31))) == {"old day"}
    with pytest.raises(ValueError, match="folders"):
        countries(choice=FolderChoice(True, start=dt.date(2026, 1, 1)))


def test_rows_metadata_and_types(spark, tmp_path):
    put(tmp_path, "20251106/s/Acme AA-BB-123-4567 Site SupplyMethod.csv", ",,\n" + supply("NA", "007"))
    (r,) = curate.curate_kind(spark, "site_supply", params(tmp_path)).rows.collect()
    assert r.asDict() == {
        "study_protocol": "AA-BB-123-4567", "country": None, "site_id": "007", "comparator_name": "Comp",
        "site_level_supply_method": "central", "site_status": "Open", "extract_date": dt.date(2025, 11, 6),
        "source_file": "Acme AA-BB-123-4567 Site SupplyMethod.csv", "processed_timestamp": dt.datetime(2025, 1, 2, 3),
    }


def test_subject_headers_go_through_the_mapping(spark, tmp_path):
    sheet = mapping(spark, **{"AA-BB-1-1": lambda h: f" 1 {h} ", "AA-BB-2-2": lambda h: None if h == "TPC" else f"2 {h}"})
    put(tmp_path, "20250101/a/AA-BB-1-1_Subject Summary.csv", "1 Site ID, 1 Subject Number ,1 TPC,1 Date Randomized,Extra\n5,10,x,6 Nov 2025,e\n")
    put(tmp_path, "20250101/b/AA-BB-2-2_Subject Summary.csv", "2 TPC,2 Subject Number,Country\nx,11,raw name\n")
    put(tmp_path, "20250101/c/AA-BB-3-3_Subject Summary.csv", "a,b\n1,2\n")
    put(tmp_path, "20250101/d/no study_Subject Summary.csv", "a,b\n1,2\n")
    done = curate.curate_kind(spark, "subject", params(tmp_path), sheet)
    got = {r["subject_number"]: r for r in done.rows.collect()}
    assert set(got) == {10, 11} and done.rows.columns == conform.KINDS["subject"].columns
    assert (got[10]["site_id"], got[10]["tpc"], got[10]["date_randomized"]) == (5, "x", dt.date(2025, 11, 6))
    # a header that already has the standard name needs no mapping
    assert (got[11]["tpc"], got[11]["country"]) == (None, "raw name")
    errors = {r["name"][:9]: r["error"] for r in done.rejected.collect()}
    assert errors == {"AA-BB-3-3": conform.UNKNOWN_STUDY, "no study_": conform.NO_STUDY}
    with pytest.raises(ValueError, match="header mapping"):
        curate.curate_kind(spark, "subject", params(tmp_path))
    with pytest.raises(ValueError, match="lacks"):
        curate.curate_kind(spark, "subject", params(tmp_path), sheet.where("`Column Header` <> 'TPC'"))


def test_missing_column_in_every_file_is_an_error(spark, tmp_path):
    put(tmp_path, "20250101/a/AA-BB-1-1 Site SupplyMethod.csv", "Country,Site ID\nx,1\n")
    with pytest.raises(ValueError, match="comparator_name"):
        curate.curate_kind(spark, "site_supply", params(tmp_path))
    put(tmp_path, "20250101/b/AA-BB-1-2 Site SupplyMethod.csv", supply("y"))
    rows = curate.curate_kind(spark, "site_supply", params(tmp_path)).rows.collect()
    assert {(r["country"], r["comparator_name"]) for r in rows} == {("x", None), ("y", "Comp")}


def test_whole_run_replaces_partitions_and_keeps_what_has_no_files(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "tables")
    sheet = mapping(spark, **{"AA-BB-1-1": lambda h: h})
    put(raw, "20250101/a/AA-BB-1-1 Site SupplyMethod.csv", supply("first"))
    put(raw, "20250101/a/AA-BB-1-1 Subject Summary.csv", "Subject Number,Country\n1,x\n")
    assert set(curate.run_curation(spark, params(raw), sheet, target)) == {"subject", "site_supply"}
    put(raw, "20250201/a/AA-BB-1-1 Site SupplyMethod.csv", supply("second"))
    curate.run_curation(spark, params(raw), sheet, target)
    put(raw, "20250201/a/AA-BB-1-1 Site SupplyMethod.csv", supply("second again"))
    curate.run_curation(spark, params(raw), sheet, target)
    table = tables.scan(spark, f"{target}/site_supply")
    assert {r["country"] for r in table.collect()} == {"first", "second again"}
    # the second folder has no subject file: its table stays
    assert tables.scan(spark, f"{target}/subject").count() == 1
    curate.run_curation(spark, params(raw), sheet, target, whole_kinds=("site_supply",))
    assert {r["country"] for r in tables.scan(spark, f"{target}/site_supply").collect()} == {"second again"}
    # only unreadable files: nothing is written
    put(raw, "20250301/a/AA-BB-1-1 Site SupplyMethod.csv", "one cell\n")
    curate.run_curation(spark, params(raw), sheet, target, whole_kinds=("site_supply",))
    assert {r["country"] for r in tables.scan(spark, f"{target}/site_supply").collect()} == {"second again"}


def test_layout_begins_at_the_root(spark, tmp_path):
    root = tmp_path / "2024"
    put(root, "20240101/Acme AA-BB-1-1 Site SupplyMethod.csv", supply("in the date folder"))
    put(root, "20240101/study 1/Acme AA-BB-1-1 Site SupplyMethod.csv", supply("in a study folder"))
    rows = curate.curate_kind(spark, "site_supply", params(root, latest_only=False)).rows
    assert {r["country"] for r in rows.collect()} == {"in the date folder", "in a study folder"}


def test_an_empty_newest_folder_is_the_latest(spark, tmp_path):
    put(tmp_path, "20250101/study 1/Acme AA-BB-1-1 Site SupplyMethod.csv", supply("old day"))
    (tmp_path / "20250202").mkdir()
    assert discovery.chosen_folder_names(spark, str(tmp_path)) == ["20250202"]
    assert curate.curate_kind(spark, "site_supply", params(tmp_path)) is None


def test_kind_glob_covers_any_case_and_order(spark, tmp_path):
    for name in ("My SITE x inventory.CSV", "inventory of Site.csv", "Depot Inventory.csv"):
        put(tmp_path, name, "x")
    files = discovery.list_files(spark, str(tmp_path), glob=discovery.kind_glob("site"))
    assert {r["path"].rsplit("/", 1)[1] for r in files.collect()} == {"My SITE x inventory.CSV", "inventory of Site.csv"}


def test_header_mapping_needs_its_first_column(spark, tmp_path):
    spark.createDataFrame([("a", "b")], "x string, y string").write.parquet(str(tmp_path / "m"))
    with pytest.raises(ValueError, match="Column Header"):
        curate.load_header_mapping(spark, str(tmp_path / "m"))
    (tmp_path / "m.csv").write_text("Column Header,S1\nSite ID,Site\nCountry, \n")
    sheet = curate.load_header_mapping(spark, str(tmp_path / "m.csv"))
    assert [tuple(r) for r in conform.study_headers(sheet).collect()] == [("S1", "Site", "Site ID")]


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    rows = spark.range(10).select("id", F.date_add(F.lit(dt.date(2025, 1, 1)), (F.col("id") % 3).cast("int")).alias("extract_date"))
    sinks.write_partitions(rows, str(tmp_path / "t"))
    latest = tables.latest_snapshot(tables.scan(spark, str(tmp_path / "t")), "extract_date")
    assert {r["id"] for r in latest.collect()} == {2, 5, 8}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extract_date" in plan


def test_output_checks_find_faults(spark):
    from dosecast.params import ForecastParams

    good = ("S", 1, 2, 3, "Randomized", "x", "arm", "t", "D", 1, "Cycle 1 Day 1", 1, 1, dt.date(2025, 2, 1), None, None)
    rows = [good, good, good[:8] + (None, 1, "Cycle 0 Day 1", 0, 1, dt.date(2024, 1, 1), None, None)]
    found = quality.output_checks(spark.createDataFrame(rows, FORECAST_SCHEMA), ForecastParams(as_of_date=dt.date(2025, 1, 1)))
    found = {r["check_name"]: r["n_rows"] for r in found.collect() if r["n_rows"]}
    assert found == {
        "date_not_in_future": 1, "cycle_or_day_not_positive": 1, "drug_missing": 1, "null_drug_dispensed": 1, "duplicate_visit": 1,
    }
