import datetime as dt

import pytest
from pyspark.sql import functions as F

from dosecast import fixed_values as fixed
from dosecast.functions import text, values
from dosecast.operators import conform, prepare


def each(spark, inputs, expr):
    """Expression value for every input, in order."""
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, v string")
    return [r["out"] for r in rows.orderBy("i").select(expr(F.col("v")).alias("out")).collect()]


def test_cycle_and_day(spark):
    visits = ["TPC C20D8", "Cycle 46 Day 8", "Crossover Cycle 5 Day 1", "Cycle46", "Cycle 46", "Screening", None, "cycle 3 day 2"]
    assert each(spark, visits, text.cycle_number) == [20, 46, 5, 46, 46, 0, 0, 3]
    assert each(spark, visits, text.day_number) == [8, 8, 1, 1, 1, 1, 1, 2]
    assert each(spark, ["Cycle 99999999999", "C99999999999999999999"], text.cycle_number) == [99999999999, None]


def test_visit_days(spark):
    given = ["1,8,15", "1, 8,15", "Day 1, Day 8", None, "1,1", "-1,8,x", ""]
    assert each(spark, given, text.visit_days) == [[1, 8, 15], [1, 8, 15], [], [], [1, 1], [8], []]


def test_clean_text(spark):
    given = ["  Physician’s ", "“A”", None, "", "Keeps Case"]
    assert each(spark, given, text.clean_text) == ["Physician's", '"A"', None, "", "Keeps Case"]


def test_prefix(spark):
    given = ["TPC then CROSSOVER", "tpc C1", "Cycle 1", None]
    assert each(spark, given, text.visit_prefix) == ["Crossover ", "TPC ", "", ""]


def test_drug_bases(spark):
    countries = F.array(F.lit("asia"), F.lit("europe"), F.lit("asia minor"))
    given = ["Asia - Druga 10mg/vial", "Asia-Druga 2mg", "Druga 150mg (10mg/mL)", "Druga (100 mg/vial)", "Asia Minor-Druga 1", None]
    assert each(spark, given, lambda c: text.drug_base_of_mapping(c, countries)) == ["Druga"] * 5 + [None]
    given = ["Druga 50 mg/vial", "Nab-Druga", "Druga (100 mg/vial)", "Asia-Druga 2mg", None]
    assert each(spark, given, text.drug_base_of_match) == ["Druga", None, None, "Asia-Druga", None]


def test_study_from_name(spark):
    names = ["Acme AA-BB-123-4567_Subject Summary.csv", "Invalid_File_Name.csv", "AA-BB-12x-1.csv"]
    got = each(spark, names, lambda c: text.study_from_name(c, r"AA-BB-\d+-\d+"))
    assert got == ["AA-BB-123-4567", None, None]
    with pytest.raises(ValueError):
        text.check_pattern(".*")


def test_file_kinds(spark):
    names = ["x Subject Summary 1.csv", "Site Depot Inventory.csv", "depot INVENTORY.CSV", "Site SupplyMethod.csv",
             "Country SupplyMethod.csv", "Subject Summary.xlsx", "other.csv"]
    got = each(spark, names, lambda c: text.file_kind(F.lower(c)))
    assert got == ["subject", "site", "depot", "site_supply", "country_supply", None, None]


def test_dates(spark):
    given = ["01-Jan-2024", "15-Feb-2024", "6 Nov 2025", "31-DEC-2023", "xx", None, "30-Feb-2024"]
    assert each(spark, given, values.parse_date) == [
        dt.date(2024, 1, 1), dt.date(2024, 2, 15), dt.date(2025, 11, 6), dt.date(2023, 12, 31), None, None, None,
    ]


def test_whole_numbers(spark):
    given = ["8", " 8 ", "8.0", "x", "99999999999", None]
    assert each(spark, given, lambda c: values.whole_number(c, "int")) == [8, 8, 8, None, None, None]


def test_headers_give_the_table_columns():
    names = [c for c, _, _ in fixed.headers(fixed.DEPOT_HEADERS)]
    assert "quantity_study_drug_packaged_unavailable" in names and len(names) == 20
    assert "next_min_study_visit_date" in [c for c, _, _ in fixed.headers(fixed.SUBJECT_HEADERS)]
    counts = {name: len(kind.columns) for name, kind in conform.KINDS.items()}
    assert counts == {"subject": 30, "depot": 24, "site": 25, "site_supply": 9, "country_supply": 7}
    assert len(fixed.SUBJECT_COLUMNS) == 27 and len(fixed.MAPPING_COLUMNS) == 12


def test_active_keeps_null_status_and_is_case_sensitive(spark):
    rows = spark.createDataFrame([("Enrolled",), ("enrolled",), (None,), ("Randomized",)], "subject_status string")
    kept = [r[0] for r in prepare.active_subjects(rows).collect()]
    assert kept == ["enrolled", None, "Randomized"]
    kept = [r[0] for r in prepare.active_subjects(rows, ("Randomized",)).collect()]
    assert kept == ["Enrolled", "enrolled", None]


def test_sparse_rows_and_cast(spark):
    rows = spark.createDataFrame([("a", None), ("a", "b"), (None, None)], "x string, y string")
    assert conform.drop_sparse_rows(rows).count() == 1
    with pytest.raises(ValueError, match="missing"):
        conform.cast_to_schema(rows, {"x": "string", "z": "int"})
    assert conform.cast_to_schema(rows, {"y": "int", "x": "string"}).dtypes == [("y", "int"), ("x", "string")]
