import datetime as dt
import random

import pytest

from dosecast.operators.project import REASONS, bounded, project_visits
from dosecast.params import ForecastParams

TODAY = dt.date(2025, 1, 10)
PLAN = (
    "study_protocol string, subject_number bigint, drug_dispensed string, last_study_visit_date date, "
    "parsed_last_visit_cycle int, parsed_last_visit_day int, visit_days string, dispensing_frequency_days bigint, "
    "max_cycles double, is_crossover boolean, is_tpc boolean"
)


def project(spark, cases, **kw):
    """{case number: [(label, cycle, day, date)]} in date order."""
    rows = [
        ("S", i, "D", last, cycle, day, days, length, cap, crossover, False)
        for i, (last, cycle, day, days, length, cap, crossover) in enumerate(cases)
    ]
    visits = project_visits(spark.createDataFrame(rows, PLAN), ForecastParams(as_of_date=TODAY, **kw))
    out = {i: [] for i in range(len(cases))}
    for r in visits.collect():
        out[r["subject_number"]].append((r["predicted_study_visit"], r["cycle"], r["day"], r["predicted_next_visit_date"]))
    return {i: sorted(v, key=lambda x: (x[3], x[1], x[2])) for i, v in out.items()}


def d(text):
    return dt.date.fromisoformat(text)


# last visit, cycle, day, pattern, length, cap, crossover -> rows, first, last
GOLDEN = [
    ((d("2025-01-15"), 20, 8, "1,8,15", 28, 25.0, False), 16, ("Cycle 20 Day 15", "2025-01-22"), ("Cycle 25 Day 15", "2025-06-11")),
    ((d("2025-01-05"), 10, 1, "1,15", 28, None, False), 26, ("Cycle 10 Day 15", "2025-01-19"), ("Cycle 23 Day 1", "2026-01-04")),
    ((d("2025-01-05"), 5, 1, "1,8", 21, None, True), 35, ("Crossover Cycle 5 Day 8", "2025-01-12"), ("Crossover Cycle 22 Day 8", "2026-01-04")),
    ((d("2024-11-01"), 10, 1, "1", 28, None, False), 13, ("Cycle 11 Day 1", "2025-01-24"), None),
    ((d("2025-01-15"), 48, 1, "1,15", 28, 50.0, False), 5, ("Cycle 48 Day 15", "2025-01-29"), ("Cycle 50 Day 15", "2025-03-26")),
    ((d("2025-01-05"), 5, 15, "1,4,8,11,15,18,22,25", 28, None, False), 105, ("Cycle 5 Day 18", "2025-01-08"), None),
    ((d("2024-11-15"), 10, 1, "1", 28, None, False), None, ("Cycle 11 Day 1", "2025-02-07"), None),
]


def test_worked_cases(spark):
    got = project(spark, [case for case, *_ in GOLDEN])
    for i, (_, n, first, last) in enumerate(GOLDEN):
        labels = [(label, str(date)) for label, _, _, date in got[i]]
        assert labels[0] == first, i
        assert n is None or len(labels) == n, i
        assert last is None or labels[-1] == last, i


def walk(last, cycle, day, days, length, cap, horizon_days, renumber):
    """The same visits by stepping cycle after cycle."""
    pattern = sorted(int(t) for t in (days or "").split(",") if t.strip().isdigit()) or [1]
    length = length if length and length > 0 else 28
    horizon = TODAY + dt.timedelta(horizon_days)
    cap = int(cap) if cap is not None and cap >= 1 else 10**9
    start = last - dt.timedelta(day - 1)
    out = [(cycle, x, start + dt.timedelta(x - 1)) for x in pattern if x > day and cycle <= cap]
    out = [v for v in out if v[2] <= horizon]
    start, cycle = start + dt.timedelta(length), cycle + 1
    if start < TODAY:
        while start <= TODAY:
            start += dt.timedelta(length)
            cycle += 1 if renumber else 0
    # far enough: the pattern reaches at most 40 days into a cycle
    while start <= horizon + dt.timedelta(60) and cycle <= cap:
        out += [(cycle, x, start + dt.timedelta(x - 1)) for x in pattern if start + dt.timedelta(x - 1) <= horizon]
        start, cycle = start + dt.timedelta(length), cycle + 1
    return sorted(out, key=lambda v: (v[2], v[0], v[1]))


@pytest.mark.parametrize(("horizon_days", "renumber"), [(365, False), (40, True), (0, False)])
def test_closed_form_against_stepping(spark, horizon_days, renumber):
    rng = random.Random(horizon_days)
    cases = []
    for _ in range(400):
        cases.append(
            (
                TODAY + dt.timedelta(rng.randint(-400, 500)),
                rng.randint(0, 30),
                rng.choice([1, 1, 8, 15, 30]),
                rng.choice([None, "x", "1", "1,8", "15,1,8", "0,8", "40", "1,1", "29,30"]),
                rng.choice([None, 0, -7, 1, 7, 21, 28, 42]),
                rng.choice([None, 0.5, 1.0, 12.9, 20.0, 31.0]),
                False,
            )
        )
    got = project(spark, cases, horizon_days=horizon_days, renumber_missed=renumber)
    for i, (last, cycle, day, days, length, cap, _) in enumerate(cases):
        expected = walk(last, cycle, day, days, length, cap, horizon_days, renumber)
        assert [(c, x, date) for _, c, x, date in got[i]] == expected, cases[i]


def test_no_rows_without_date_or_subject(spark):
    got = project(spark, [(None, 1, 1, "1", 28, None, False)])
    assert got == {0: []}


BIG = 2**63 - 1
# last visit, cycle, day, pattern, length, cap, reason
BROKEN = [
    (None, 1, 1, "1", 28, None, "no last visit date"),
    (d("2025-01-05"), None, 1, "1", 28, None, "visit number too long"),
    (d("2025-01-05"), BIG, 1, "1", 28, None, "visit number too long"),
    (d("2025-01-05"), 1, None, "1", 28, None, "visit number too long"),
    (d("2025-01-05"), 1, BIG, "1", 28, None, "cycle starts before the calendar"),
    (d("2025-01-05"), 1, 200_000, "1", 28, None, "cycle starts before the calendar"),
    (d("2025-01-05"), 1, 1, "1", BIG, None, "next cycle after the calendar"),
    (d("2025-01-05"), 1, 1, "1", 100_000, None, "next cycle after the calendar"),
    (d("2025-01-05"), 1, 1, f"1,{BIG}", 28, None, "visit days after the calendar"),
    (d("2025-01-05"), 1, 1, "99999999999999999999", 28, None, "visit days after the calendar"),
    (d("2025-01-05"), 9, 1, "1,90000", 28, 5.0, "visit days after the calendar"),
    (d("2025-01-05"), 9, BIG - 1, "1,90000", 28, 5.0, "cycle starts before the calendar"),
    (d("2025-01-05"), 9, 90_000, "1,90000", 28, 5.0, None),
    (d("2025-01-05"), 3_000_000_000, 1, "1,8", 28, None, None),
    (d("1700-01-05"), 3, 1, "1,8", 28, 1e300, None),
    (d("2261-12-31"), 3, 1, "1", 28, None, None),
    (d("2262-03-31"), 3, 1, "1", 28, None, "next cycle after the calendar"),
]


def test_numbers_that_leave_the_calendar_have_a_reason(spark):
    rows = [("S", i, "D", *case[:6], False, False) for i, case in enumerate(BROKEN)]
    rows.append(("S", None, "D", d("2025-01-05"), 1, 1, "1", 28, None, False, False))
    plan = spark.createDataFrame(rows, PLAN.replace("_cycle int", "_cycle bigint").replace("_day int", "_day bigint"))
    found = {r.subject_number: r.reason for r in bounded(plan, ForecastParams(as_of_date=TODAY)).collect()}
    assert found == {i: case[-1] for i, case in enumerate(BROKEN)} | {None: "no subject number"}
    assert set(found.values()) - {None} == set(REASONS)
    visits = project_visits(plan, ForecastParams(as_of_date=TODAY)).collect()
    labels = {r.predicted_study_visit for r in visits if r.subject_number == 13}
    assert "Cycle 3000000000 Day 8" in labels and "Cycle 3000000001 Day 1" in labels
    assert {r.subject_number for r in visits} == {13, 14}


def test_report_of_a_write_comes_from_one_job(spark, tmp_path):
    from dosecast.plans.forecast import build_plan, write_forecast
    from dosecast.workload import adapters as view

    sf = "/root/testdata/sf0.001"
    inputs = view.odd_subjects(spark, sf), view.odd_mapping(spark, sf)
    sc = spark.sparkContext
    sc.setJobGroup("observed", "observed")
    build_plan(*inputs, view.PARAMS).write.format("noop").mode("overwrite").save()
    without = len(sc.statusTracker().getJobIdsForGroup("observed"))
    sc.setJobGroup("written", "written")
    report = write_forecast(*inputs, view.PARAMS, str(tmp_path / "forecast"))
    assert len(sc.statusTracker().getJobIdsForGroup("written")) <= without
    sc._jsc.clearJobGroup()
    counts = {r.check_name: r.n_rows for r in report.collect()}
    assert counts["visits"] == spark.read.parquet(str(tmp_path / "forecast")).count() > 0
    lost = sum(n for name, n in counts.items() if name.startswith("unprojected"))
    assert 0 < lost < counts["plan_rows"] and counts["visits without cycle"] > 0
