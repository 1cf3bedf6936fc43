"""The forecast and its rollups in tasks of a bounded number of subjects, and what moves between them."""

import datetime as dt
import re

from pyspark.sql import functions as F

from dosecast.fixed_values import FORECAST_SORT
from dosecast.operators import plan as planning
from dosecast.operators import rollup
from dosecast.plans import forecast as job
from dosecast.sources import tables
from dosecast.workload import adapters as view

P = view.PARAMS


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_follow_the_number_of_subjects(spark, sf, monkeypatch):
    monkeypatch.setattr(planning, "SUBJECTS", 10)
    people, _ = job.prepared_inputs(view.subjects(spark, sf), view.mapping(spark, sf), P)
    dealt, tasks = planning.deal(people)
    assert tasks >= people.count() // 12 and dealt.rdd.getNumPartitions() == tasks


def test_rows_of_a_match_are_not_shuffled(spark, sf):
    plan = executed(job.build_plan(view.subjects(spark, sf), view.mapping(spark, sf), P))
    above = plan[: plan.index("BroadcastHashJoin")]
    assert "Exchange" not in above and "Window" in above


def test_subjects_with_many_rows_are_few_before_the_match(spark):
    rows = spark.range(5000).select(
        F.lit("S").alias("study_protocol"), F.lit(None).cast("int").alias("subject_number"), F.lit("Arm").alias("randomized_treatment"),
        F.lit("T").alias("tpc"), F.lit("Randomized").alias("subject_status"), F.lit("Asia").alias("country"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("site_id"), F.lit(7).alias("parent_depot"),
        F.lit("Cycle 1 Day 1").alias("last_study_visit_recorded"), F.lit(dt.date(2001, 8, 1)).alias("last_study_visit_date"),
        F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("id").cast("int")).alias("extract_date"),
    )
    schema = "study_protocol string, randomized_treatment string, tpc string, subject_status string, study_drug_dispensed string, country string, dispensing_quantity bigint, visit_days string"
    mapping = spark.createDataFrame([("S", "Arm", "T", "Randomized", "D", None, 3, "1,8")], schema)
    people, _ = job.prepared_inputs(rows, mapping, P)
    assert planning.first_by_nulls(people).count() == 2
    (r,) = job.build_plan(rows, mapping, P).collect()
    assert (r["total_medicines_required_per_cycle"], r["site_id"], r["extract_date"]) == (5000 * 6, 0, dt.date(1990, 1, 1))


def test_sorted_forecast_moves_plan_rows_only(spark, sf):
    out = job.forecast(view.subjects(spark, sf), view.mapping(spark, sf), P, sort=True)
    ranges = re.findall(r"rangepartitioning\((.*?) ASC.*\n", executed(out))
    assert ranges and not any("rangepartitioning" in line and "cycle" in line for line in executed(out).splitlines())
    got = [tuple((r[c] is None, r[c] or 0) if c != "study_name" else r[c] for c in FORECAST_SORT) for r in out.collect()]
    assert got == sorted(got) and len(got) == job.forecast(view.subjects(spark, sf), view.mapping(spark, sf), P).count()


def test_rollups_count_subjects_of_several_sites_and_none(spark):
    month = dt.date(2001, 9, 3)
    given = [("S1", n, d, s, "D", 2, month) for n in (1, 2, None) for d, s in ((1, 5), (1, 6), (None, 5), (1, 5))]
    given += [("S2", 1, 1, 5, "D", None, month), (None, 1, 2, 5, "D", 1, month)]
    schema = (
        "study_name string, subject_number bigint, parent_depot int, site_id int, drug_dispensed string, dispensing_quantity bigint, "
        "predicted_next_visit_date date"
    )
    rows = spark.createDataFrame(given, schema).repartition(3)
    every = rollup.demand_all_levels(rows)
    for level, column in rollup.LEVELS.items():
        want = rows.groupBy(column, "drug_dispensed", F.trunc("predicted_next_visit_date", "month").alias("month")).agg(
            F.sum("dispensing_quantity"), F.count(F.lit(1)), F.count_distinct(F.struct("study_name", "subject_number"))
        )
        want = {tuple(r) for r in want.collect()}
        assert {tuple(r) for r in rollup.demand(rows, level).collect()} == want
        one = every.where(F.col("level") == level).select(column, "drug_dispensed", "month", "quantity", "n_visits", "n_subjects")
        assert {tuple(r) for r in one.collect()} == want


def test_rollup_shuffles_cells_alone(spark, sf):
    forecast = job.forecast(view.subjects(spark, sf), view.mapping(spark, sf), P)
    for df in (rollup.demand_all_levels(forecast), rollup.demand(forecast, "site")):
        above = executed(df)
        above = above[: above.index("BroadcastHashJoin")]
        assert "Expand" not in above
        assert not [line for line in above.splitlines() if "Exchange hashpartitioning" in line and "subject_number" in line]


def test_part_is_dealt_over_tasks_by_its_visits(spark, sf, monkeypatch):
    forecast = job.forecast(view.subjects(spark, sf), view.mapping(spark, sf), P).localCheckpoint()
    numbers = rollup.number_subjects(forecast).localCheckpoint()
    monkeypatch.setattr(rollup, "VISITS", 1000)
    plan = rollup.demand_part(forecast, numbers)._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-forecast.count() // 1000)}), REPARTITION_BY_NUM" in plan


def test_stored_table_is_spread_by_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(tables, "SPREAD_ROWS", 20)
    orders = view.table(spark, sf, "orders")
    assert tables.spread(orders, "o_custkey").rdd.getNumPartitions() == -(-orders.count() // 20)


def test_forecast_csv_is_written_compressed(spark, sf, monkeypatch):
    from pathlib import Path

    from dosecast.workload import curation_queries as cq
    from dosecast.workload import forecast_queries as fq

    for query, module, folder in ((cq.forecast_csv, cq, ""), (fq.forecast_from_csv, fq, "/forecast")):
        paths, made = [], module.fresh_path
        monkeypatch.setattr(module, "fresh_path", lambda *a, made=made, paths=paths: paths.append(made(*a)) or paths[-1])
        rows = query(spark, sf)
        files = [f.name for f in Path(paths[-1].removeprefix("file:") + folder).glob("part-*")]
        assert files and all(f.endswith(".csv.gz") for f in files)
        assert rows.count() == job.forecast(view.subjects(spark, sf), view.mapping(spark, sf), P).count()
