import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from dosecast.operators import match
from dosecast.params import ForecastParams
from dosecast.plans import forecast as job
from dosecast.sources.staging import stage

P = ForecastParams(as_of_date=dt.date(2025, 1, 10))
SUBJECTS = (
    "study_protocol string, randomized_treatment string, tpc string, subject_status string, country string, "
    "subject_number bigint, site_id int, parent_depot int, last_study_visit_recorded string, "
    "last_study_visit_date date, extract_date date"
)
MAPPING = (
    "study_protocol string, randomized_treatment string, tpc string, subject_status string, country string, "
    "study_drug_dispensed string, additional_study_drug_dispensed string, visit_days string, "
    "dispensing_quantity bigint, dispensing_frequency_days bigint, max_cycles double"
)
LAST, EXTRACT = dt.date(2025, 1, 5), dt.date(2025, 1, 9)


def subject(number, country="Asia", study="S1", arm="Arm", tpc="T", status="Randomized", visit="Cycle 1 Day 1", site=1, extract=EXTRACT):
    return (study, arm, tpc, status, country, number, site, 7, visit, LAST, extract)


def row(drug, country=None, study="S1", arm="Arm", tpc="T", status="Randomized", more=None, days="1,8", quantity=2):
    return (study, arm, tpc, status, country, drug, more, days, quantity, 28, None)


def plan_of(spark, subjects, rows, **kw):
    params = replace(P, **kw)
    plan = job.build_plan(spark.createDataFrame(subjects, SUBJECTS), spark.createDataFrame(rows, MAPPING), params)
    return {(r["subject_number"], r["drug_dispensed"]): r.asDict() for r in plan.collect()}


def drugs(spark, subjects, rows, **kw):
    return set(plan_of(spark, subjects, rows, **kw))


def test_null_keys_match_null_and_case_and_quotes_do_not_matter(spark):
    people = [subject(1, tpc=None), subject(2, arm=" physician’s ARM "), subject(3, status=None), subject(4, study=None)]
    rows = [row("A", tpc=None), row("B", arm="Physician's Arm"), row("C", status=None), row("D", study=None)]
    assert drugs(spark, people, rows) == {(1, "A"), (2, "B"), (3, "C"), (4, "D")}
    kept = plan_of(spark, people, rows)[(2, "B")]
    assert kept["randomized_treatment"] == "physician's ARM"


OVERRIDE = [
    row("Druga 50 mg/vial"),
    row("Asia - Druga 10mg/vial", country="ASIA"),
    row("Other 5 mg"),
    row("Nab-Druga"),
    row("Druga (100 mg/vial)"),
]


def test_country_row_suppresses_generic_drug_of_the_same_base(spark):
    got = drugs(spark, [subject(1, "asia"), subject(2, "Europe"), subject(3, None)], OVERRIDE)
    everything = {"Druga 50 mg/vial", "Other 5 mg", "Nab-Druga", "Druga (100 mg/vial)"}
    # a generic drug without white space before a digit has no base, so nothing suppresses it
    assert {x for n, x in got if n == 1} == (everything - {"Druga 50 mg/vial"}) | {"Asia - Druga 10mg/vial"}
    assert {x for n, x in got if n == 2} == everything
    assert {x for n, x in got if n == 3} == everything


def test_drug_listed_for_the_country_is_not_suppressed(spark):
    rows = [row("Druga 50 mg"), row("Druga 50 mg", country="Asia"), row("Asia-Druga 2mg", country="Asia")]
    plan = plan_of(spark, [subject(1)], rows)
    assert set(plan) == {(1, "Druga 50 mg"), (1, "Asia-Druga 2mg")}
    assert plan[(1, "Druga 50 mg")]["total_medicines_required_per_cycle"] == 8


def test_exclusive_and_flat_modes(spark):
    people = [subject(1, "Asia"), subject(2, "Europe")]
    rows = [row("G 1"), row("A", country="Asia")]
    assert drugs(spark, people, rows, match_mode="exclusive") == {(1, "A"), (2, "G 1")}
    assert drugs(spark, people, rows, match_mode="flat") == {(1, "A"), (1, "G 1"), (2, "A"), (2, "G 1")}
    assert drugs(spark, people, rows) == {(1, "A"), (1, "G 1"), (2, "G 1")}
    with pytest.raises(ValueError):
        replace(P, match_mode="other")


@pytest.mark.parametrize("mode", ["tiered", "exclusive", "flat"])
def test_mapping_too_large_to_broadcast_gives_the_same(spark, mode):
    people = [subject(i, ["Asia", "asia", "Europe", None][i % 4]) for i in range(60)]
    here = drugs(spark, people, OVERRIDE, match_mode=mode)
    assert drugs(spark, people, OVERRIDE, match_mode=mode, broadcast_bytes=0) == here


def test_hot_key_is_spread_and_planned_without_broadcast(spark):
    people = spark.range(4000).select(
        F.lit("S1").alias("study_protocol"), F.lit("Arm").alias("randomized_treatment"), F.lit("T").alias("tpc"),
        F.lit("Randomized").alias("subject_status"), F.lit("Asia").alias("country"), F.col("id").alias("subject_number"),
        F.lit(1).alias("site_id"), F.lit(7).alias("parent_depot"), F.lit("Cycle 1 Day 1").alias("last_study_visit_recorded"),
        F.lit(LAST).alias("last_study_visit_date"), F.lit(EXTRACT).alias("extract_date"),
    )
    people, side = job.prepared_inputs(people, spark.createDataFrame(OVERRIDE, MAPPING), P)
    matched = match.match_generic(people, side, 0)
    assert len(matched.collect()) == 16000
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_drug_choice(spark):
    rows = [row("P", more="X"), row(None, more="Y"), row(None)]
    assert drugs(spark, [subject(1)], rows) == {(1, "P"), (1, "Y")}
    assert drugs(spark, [subject(1)], rows, both_drugs=True) == {(1, "P"), (1, "X"), (1, "Y")}


def test_first_non_null_in_order_whatever_the_partitioning(spark):
    people = [
        subject(1, visit=None, site=None, extract=dt.date(2025, 1, 1)),
        subject(1, visit="TPC C2D1", site=None, extract=dt.date(2025, 1, 2)),
        subject(1, visit="Crossover C3D8", site=5, extract=dt.date(2025, 1, 3)),
    ]
    mapping = spark.createDataFrame([row("A")], MAPPING)
    for turn in range(3):
        given = spark.createDataFrame(people[turn:] + people[:turn], SUBJECTS).repartition(3)
        (r,) = job.build_plan(given, mapping, P).collect()
        assert (r["site_id"], r["last_study_visit_recorded"], r["extract_date"]) == (5, "TPC C2D1", dt.date(2025, 1, 1))
        # parsed from the first row, which has no visit; the flags follow the first visit there is
        assert (r["parsed_last_visit_cycle"], r["parsed_last_visit_day"]) == (0, 1)
        assert (r["is_tpc"], r["is_crossover"]) == (True, False)
        assert r["total_medicines_required_per_cycle"] == 12


def test_first_values_of_a_key_with_many_rows(spark):
    from random import Random

    from dosecast.operators.plan import plan_rows

    draw, n = Random(7), 6000
    names = ["country", "site_id", "last_study_visit_recorded"]
    given = []
    for i in range(n):
        key = 1 if i % 3 else i % 50  # one key has two thirds of all rows
        given.append((key, draw.randrange(2), i * 7919 % n, *[f"v{i}" if draw.random() < 0.02 else None for _ in names]))
    rows = spark.createDataFrame(given, "subject_number int, tier int, at int, " + ", ".join(f"{c} string" for c in names))
    ready = rows.selectExpr(
        "'S' AS study_protocol", "subject_number", "'D' AS drug_dispensed", "tier", "struct(at) AS _subject_order",
        "struct(0 AS z) AS _mapping_order", "at AS visit_count_per_cycle", "1 AS parsed_last_visit_cycle",
        "1 AS parsed_last_visit_day", "2 AS total_medicines_required_per_cycle", *names,
    )
    want = {}
    for key in {g[0] for g in given}:
        group = sorted((g for g in given if g[0] == key), key=lambda g: g[1:3])
        firsts = [next((g[3 + j] for g in group if g[3 + j] is not None), None) for j in range(3)]
        want[key] = (2 * len(group), group[0][2], *firsts)
    for parts in (1, 7):
        plan = plan_rows(ready.repartition(parts))
        got = {r.subject_number: (r[3], r.visit_count_per_cycle, *[r[c] for c in names]) for r in plan.collect()}
        assert got == want
    assert "min_by" not in plan._jdf.queryExecution().executedPlan().toString()


def test_no_match_gives_an_empty_typed_forecast(spark):
    out = job.forecast(
        spark.createDataFrame([subject(1)], SUBJECTS), spark.createDataFrame([row("A", study="other")], MAPPING), P, sort=True
    )
    assert out.count() == 0 and len(out.columns) == 16


def test_null_quantity_counts_as_nothing(spark):
    plan = plan_of(spark, [subject(1)], [row("A", quantity=None)])
    assert plan[(1, "A")]["total_medicines_required_per_cycle"] == 0


def test_subject_filter_and_plan_shape(spark):
    people = spark.createDataFrame([subject(1), subject(2)], SUBJECTS)
    mapping = stage(spark.createDataFrame(OVERRIDE, MAPPING), "mapping")
    out = job.forecast(people, mapping, P, subject_filter="subject_number = 2")
    assert {r["subject_number"] for r in out.select("subject_number").collect()} == {2}
    plan = out._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "NestedLoop", "SortMergeJoin", "Python"):
        assert forbidden not in plan
