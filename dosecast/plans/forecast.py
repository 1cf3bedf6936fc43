"""Subjects and treatment mapping to a visit forecast."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dosecast.operators import match, plan, prepare, project
from dosecast.params import ForecastParams
from dosecast.sources import catalog, sinks, tables


def prepared_inputs(
    subjects: DataFrame, mapping: DataFrame, params: ForecastParams, subject_filter: Column | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Active, normalised subjects and the normalised mapping side."""
    people = prepare.active_subjects(
        prepare.prepare_subjects(subjects, keep=params.subject_order), params.excluded_statuses
    )
    people = prepare.normalize_subjects(people)
    if subject_filter is not None:
        people = people.where(subject_filter)
    rows = prepare.normalize_mapping(prepare.prepare_mapping(mapping, keep=params.mapping_order))
    return match.subject_side(people, params.subject_order), match.mapping_side(rows, params.mapping_order)


def build_plan(
    subjects: DataFrame, mapping: DataFrame, params: ForecastParams, subject_filter: Column | str | None = None
) -> DataFrame:
    """One row per study, subject and drug. Subject rows are stored on the way."""
    return _planned(subjects, mapping, params, subject_filter)[0]


def _planned(
    subjects: DataFrame, mapping: DataFrame, params: ForecastParams, subject_filter: Column | str | None
) -> tuple[DataFrame, int]:
    """The plan, and the number of tasks it is dealt over."""
    people, side = prepared_inputs(subjects, mapping, params, subject_filter)
    dealt, tasks = plan.deal(people)
    matched = match.MATCHERS[params.match_mode](dealt, side, params.broadcast_bytes)
    return plan.plan_rows(match.with_drug(matched, params.both_drugs)), tasks


def forecast_visits(
    subjects: DataFrame, mapping: DataFrame, params: ForecastParams, subject_filter: Column | str | None = None
) -> DataFrame:
    """Future visits with all plan columns, for checks and extra reports."""
    return project.project_visits(build_plan(subjects, mapping, params, subject_filter), params)


def forecast(
    subjects: DataFrame,
    mapping: DataFrame,
    params: ForecastParams,
    subject_filter: Column | str | None = None,
    sort: bool = False,
) -> DataFrame:
    """The forecast table. Lazy but for storing the subject rows and measuring the size of the mapping.

    With ``sort`` in the order of the written report. Plan rows take their places by its leading columns, which a visit has from
    its plan row; visits are only sorted within a task, so none of them moves.
    """
    rows, tasks = _planned(subjects, mapping, params, subject_filter)
    bounds = project.cycle_bounds(rows, params)
    if sort:
        bounds = project.in_report_order(bounds, tasks)
    return project.shape_output(project.visits_of(bounds, params), params, sort)


WHOLE_NUMBERS = ("parent_depot", "site_id", "subject_number", "dispensing_quantity", "cycle", "day")


def write_forecast(
    subjects: DataFrame,
    mapping: DataFrame,
    params: ForecastParams,
    path: str,
    subject_filter: Column | str | None = None,
) -> DataFrame:
    """Write the forecast table and return (check_name, n_rows) of what the write saw.

    Plan rows, those of them without visits by reason, visits, and visits without a whole number that the table needs. The counts
    are metrics observed on the way to the files, so nothing is read or worked out a second time. Both observations come
    after the last shuffle, in the tasks that write.
    """
    plan_seen, visits_seen = Observation(), Observation()
    rows = project.bounded(build_plan(subjects, mapping, params, subject_filter), params)
    lost = {f"unprojected: {r}": F.count_if(F.col("reason") == r) for r in project.REASONS}
    rows = rows.observe(plan_seen, F.count(F.lit(1)).alias("plan_rows"), *[c.alias(n) for n, c in lost.items()])
    out = project.shape_output(project.visits_of(rows.where("reason IS NULL").drop("reason"), params), params)
    missing = {f"visits without {c}": F.count_if(F.col(c).isNull()) for c in WHOLE_NUMBERS}
    out = out.observe(visits_seen, F.count(F.lit(1)).alias("visits"), *[c.alias(n) for n, c in missing.items()])
    sinks.write_whole(out, path)
    counts = [*plan_seen.get.items(), *visits_seen.get.items()]
    return subjects.sparkSession.createDataFrame(counts, "check_name string, n_rows bigint")


def forecast_from_csv(
    spark: SparkSession,
    subjects_path: str,
    mapping_path: str,
    params: ForecastParams,
    output_path: str | None = None,
    compression: str = "none",
) -> DataFrame:
    """Forecast out of two CSV files; with ``output_path`` also written there, sorted, as CSV (``compression``: of its files).

    Where ``params`` leaves the orders at their defaults, rows rank as they stand in the files.
    """
    if params.subject_order == ForecastParams.subject_order:
        params = replace(params, subject_order=(tables.FILE_ORDER,))
    if params.mapping_order == ForecastParams.mapping_order:
        params = replace(params, mapping_order=(tables.FILE_ORDER,))
    out = forecast(tables.subjects_csv(spark, subjects_path), tables.mapping_csv(spark, mapping_path), params, sort=True)
    if output_path:
        sinks.write_csv(out, output_path, compression)
    return out


def forecast_from_tables(
    spark: SparkSession,
    subjects_table: str,
    mapping_table: str,
    params: ForecastParams,
    output_path: str | None = None,
    snapshot_col: str = "processed_timestamp",
    output_table: str | None = None,
) -> DataFrame:
    """Forecast of the latest snapshot of a stored subject table; with ``output_path`` it replaces that table.

    With ``output_table`` it replaces the rows of that catalog table at once; its files lie below ``output_path``.
    """
    if output_table and not output_path:
        raise ValueError("output_table needs output_path, the folder of its files")
    subjects = tables.latest_snapshot(tables.scan(spark, subjects_table), snapshot_col)
    out = forecast(subjects, tables.scan(spark, mapping_table), params)
    if output_table:
        catalog.replace_table(out, output_table, output_path)
    elif output_path:
        sinks.write_whole(out, output_path)
    return out


def run_summary(forecast_rows: DataFrame) -> DataFrame:
    """Rows, distinct subjects and drugs, first and last visit date."""
    return forecast_rows.agg(
        F.count(F.lit(1)).alias("n_visits"),
        F.countDistinct("subject_number").alias("n_subjects"),
        F.countDistinct("drug_dispensed").alias("n_drugs"),
        F.min("predicted_next_visit_date").alias("first_visit"),
        F.max("predicted_next_visit_date").alias("last_visit"),
    )
