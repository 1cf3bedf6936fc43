"""Counts of what is wrong, in inputs and outputs. Nothing is filtered here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dosecast.fixed_values import CYCLE_PATTERN
from dosecast.operators import match
from dosecast.params import ForecastParams
from dosecast.plans.forecast import prepared_inputs

NOT_NULL = (
    "study_name", "parent_depot", "site_id", "subject_number", "drug_dispensed", "dispensing_quantity",
    "predicted_study_visit", "cycle", "day", "predicted_next_visit_date",
)


def counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check_name, n_rows) for each condition, in one aggregation."""
    one = df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    return one.unpivot([], list(checks), "check_name", "n_rows")


def input_checks(subjects: DataFrame, mapping: DataFrame, params: ForecastParams) -> DataFrame:
    visit = F.col("last_study_visit_recorded")
    subject_checks = counts(
        subjects,
        {
            "excluded_status": F.coalesce(F.col("subject_status").isin(*params.excluded_statuses), F.lit(False)),
            "null_status": F.col("subject_status").isNull(),
            "null_last_visit_date": F.col("last_study_visit_date").isNull(),
            "unparsable_visit": ~F.coalesce(F.rlike(visit, F.lit("(?iU)" + CYCLE_PATTERN)), F.lit(False)),
        },
    )
    mapping_checks = counts(
        mapping,
        {
            "mapping_without_study": F.col("study_protocol").isNull(),
            "mapping_without_days": F.col("visit_days").isNull(),
            "mapping_without_cycle_length": ~F.coalesce(F.col("dispensing_frequency_days") > 0, F.lit(False)),
        },
    )
    people, side = prepared_inputs(subjects, mapping, params)
    unmatched = counts(
        match.unmatched_subjects(people, side, params.broadcast_bytes), {"active_subject_unmatched": F.lit(True)}
    )
    return subject_checks.unionByName(mapping_checks).unionByName(unmatched)


def output_checks(forecast_rows: DataFrame, params: ForecastParams) -> DataFrame:
    """Past dates are a finding, not an error: the rest of the current cycle may lie before the as-of date.

    One pass: counts per visit key first, which also tells the repeated visits, then their sums. The
    forecast is already partitioned by subject, so the first step needs no further shuffle.
    """
    checks = {
        "date_not_in_future": F.col("predicted_next_visit_date") <= F.lit(params.as_of_date),
        "cycle_or_day_not_positive": (F.col("cycle") < 1) | (F.col("day") < 1),
        "drug_missing": F.col("drug_dispensed").isNull() | (F.col("drug_dispensed") == ""),
        **{f"null_{c}": F.col(c).isNull() for c in NOT_NULL if c in forecast_rows.columns},
    }
    key = ["study_name", "subject_number", "drug_dispensed", "cycle", "day", "predicted_next_visit_date"]
    per_visit = forecast_rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(c).alias(f"_{name}") for name, c in checks.items()]
    )
    one = per_visit.agg(
        *[F.coalesce(F.sum(f"_{name}"), F.lit(0)).cast("bigint").alias(name) for name in checks],
        F.count_if(F.col("_n") > 1).alias("duplicate_visit"),
    )
    return one.unpivot([], [*checks, "duplicate_visit"], "check_name", "n_rows")


def cadence_checks(visits: DataFrame) -> DataFrame:
    """Do projected visits follow their own plan row?

    Consecutive visits of one study, subject, drug and day: a gap of whole cycle lengths, the cycle
    number up by one, the day in the pattern, the cycle within the cap. One such group holds at most
    the visits of a single plan row and day, so it is bounded by the horizon.
    """
    w = W.partitionBy("study_protocol", "subject_number", "drug_dispensed", "day").orderBy(
        "predicted_next_visit_date", "cycle"
    )
    gap = F.datediff("predicted_next_visit_date", F.lag("predicted_next_visit_date").over(w))
    steps = visits.select(
        gap.alias("gap"),
        (F.col("cycle") - F.lag("cycle").over(w)).alias("step"),
        "_length", "_cap", "_days", "cycle", "day",
    )
    return counts(
        steps,
        {
            "visits": F.lit(True),
            "gap_is_one_cycle": F.col("gap") == F.col("_length"),
            "gap_is_several_cycles": (F.col("gap") > F.col("_length")) & (F.col("gap") % F.col("_length") == 0),
            "gap_off_grid": F.col("gap") % F.col("_length") != 0,
            "cycle_step_not_one": F.col("step") != 1,
            "day_outside_pattern": ~F.array_contains("_days", F.col("day")),
            "cycle_beyond_cap": F.col("cycle") > F.col("_cap"),
        },
    )
