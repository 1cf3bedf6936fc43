import importlib.util
from pathlib import Path

import pytest

import __spark_entry__ as contract

ROOT = Path(__file__).resolve().parent.parent
spec = importlib.util.spec_from_file_location("check_sql", ROOT / "tools" / "check_sql.py")
check_sql = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check_sql)

# one per family here; tools/check_sql.py runs them all
SAMPLE = [
    "match_tiered_shuffled", "plan_history", "forecast_renumbered", "rollup_sets", "quality_output",
    "latest_files", "ingest_country_supply", "partition_replace",
]


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.QUERIES) > 60


def test_entry(spark):
    out = contract.entry(spark)
    assert len(out.columns) == 16 and out.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, sf, name):
    good, note = check_sql.compare(spark, check_sql.duck(sf), sf, name)
    assert good, note
