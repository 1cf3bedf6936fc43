"""Base names by phrase lookup against removing every country in turn."""

import re

import pytest

from dosecast.operators.bases import mapping_bases

NAMES = [
    "Asia - Druga 10mg", "Druga (Asia) 5 mg", "Middle East-Drugb 3", "drugb-EAST 1", "Middle Asia East Drugc 2",
    "Middle Drugd East", "Asia-Asia Druge", "Europeasia Drugf", "x (Korea (South))", "U.S.A Drugg 1", "1 Asia", "", "Asia",
    "Drug-Land 17 h", "North-Land 100-East 9", "Über-Österreich Drugi", "country 77 9999", "Country-a b c Drugj", None,
]
COUNTRIES = ["asia", "east", "middle east", "europe", "korea (south)", "u.s.", "österreich", "a b c", "land", "north-", None, ""]


def by_trial(name, countries):
    name = re.sub(r"\d.*", "", name).strip()
    for country in sorted({c for c in countries if c}, key=lambda c: (-len(c), c)):
        word = r"\b" + re.escape(country) + r"\b"
        name = re.sub(word + "-?", "", name, flags=re.IGNORECASE)
        name = re.sub("-" + word, "", name, flags=re.IGNORECASE)
    name = re.sub(r"^[\s\-]+|[\s\-]+$", "", re.sub("[()]", "", name))
    return re.sub(r"\s{2,}", " ", name).strip()


@pytest.mark.parametrize("more", [0, 10_000])
def test_lookup_agrees_with_trying_every_country(spark, more):
    countries = [*COUNTRIES, *[f"land {chr(97 + i % 26)}{i}" for i in range(more)]]
    names = [*NAMES, *[f"Land b{i} Drug {chr(97 + i)}" for i in range(3)]]
    found = mapping_bases(
        spark.createDataFrame([(n,) for n in names], "x string"), spark.createDataFrame([(c,) for c in countries], "y string")
    )
    assert {r.drug: r.base for r in found.collect()} == {n: by_trial(n, countries) for n in names if n is not None}


def test_no_countries_and_no_names(spark):
    names = spark.createDataFrame([("Asia Druga 1",)], "x string")
    none = spark.createDataFrame([], "y string")
    assert mapping_bases(names, none).first().base == "Asia Druga"
    assert mapping_bases(names.where("false"), names).count() == 0
