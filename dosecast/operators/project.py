"""Future visits of plan rows, as one narrow expansion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.fixed_values import FORECAST_SCHEMA, FORECAST_SORT
from dosecast.functions import text, values
from dosecast.params import ForecastParams

# fixed values: first and last day that nanosecond timestamps reach. A plan row with a date beyond them is a broken one: it
# gives no visits and has a reason
EARLIEST, LATEST = dt.date(1677, 9, 22), dt.date(2262, 4, 11)
REASONS = (
    "no subject number", "no last visit date", "visit number too long", "cycle starts before the calendar",
    "next cycle after the calendar", "visit days after the calendar",
)
_EPOCH = dt.date(1970, 1, 1)
# more than the cycles that fit between EARLIEST and LATEST
_MORE_CYCLES = 1_000_000


def _epoch_day(date: dt.date) -> int:
    return (date - _EPOCH).days


def bounded(plan: DataFrame, params: ForecastParams) -> DataFrame:
    """All plan rows with day pattern, cycle length, cap, cycle starts, last cycle offset, and the ``reason`` of those that
    cannot be projected (null for the others).

    Dates are counted in days as bigint, and a value that leaves the calendar becomes null before anything is worked out
    from it, so numbers of any length in texts and mapping are judged as they are.

    ``_last_k`` is the last offset with a visit inside the horizon; offset 0 is the next cycle and -1
    the rest of the current one. The earliest day of a cycle moves by the cycle length at each step,
    so the offsets inside the horizon are contiguous and the bound is exact: nothing is generated
    beyond it.
    """
    today, horizon = _epoch_day(params.as_of_date), _epoch_day(params.horizon_date)
    first_day, last_day = _epoch_day(EARLIEST), _epoch_day(LATEST)
    length, cycle, day = F.col("dispensing_frequency_days"), F.col("parsed_last_visit_cycle"), F.col("parsed_last_visit_day")
    start = F.try_subtract(F.unix_date("last_study_visit_date").cast("bigint"), day.cast("bigint") - 1)
    rows = plan.withColumns(
        {
            "_pattern": text.visit_days(F.col("visit_days")),
            "_length": F.when(length > 0, length).otherwise(params.default_cycle_days).cast("bigint"),
            "_cap": F.when(F.col("max_cycles") >= 1, F.col("max_cycles").try_cast("bigint")),
            "_start": F.when(start >= first_day, start),
            "_cycle": F.when(F.try_add(cycle.cast("bigint"), F.lit(_MORE_CYCLES)).isNotNull(), cycle.cast("bigint")),
            "_prefix": F.when(F.col("is_crossover"), "Crossover ").when(F.col("is_tpc"), "TPC ").otherwise(""),
        }
    )
    one = F.array(F.lit(1).cast("bigint"))
    rows = rows.withColumn("_days", F.when(F.size("_pattern") == 0, one).otherwise(F.array_sort("_pattern")))
    planned = F.try_add("_start", "_length")
    rows = rows.withColumn("_planned", F.when(planned <= last_day, planned))
    behind = today - F.col("_planned")
    rows = rows.withColumn("_missed", F.when(behind > 0, F.floor(behind / F.col("_length")) + 1).otherwise(0).cast("bigint"))
    following = F.col("_planned") + F.col("_missed") * F.col("_length")
    skipped = F.col("_missed") if params.renumber_missed else F.lit(0)
    rows = rows.withColumns({"_next": F.when(following <= last_day, following), "_next_cycle": F.col("_cycle") + 1 + skipped})
    room = F.try_subtract(horizon - F.col("_next"), F.array_min("_days") - 1)
    rows = rows.withColumns(
        {
            "_by_horizon": F.greatest(F.floor(room / F.col("_length")), F.lit(-1)),
            "_by_cap": F.when(F.col("_cap").isNotNull(), F.col("_cap") - F.col("_next_cycle")),
            "_last_day": F.array_max("_days"),
        }
    )
    # the cycle after the last one is looked at too, unless the cap ends the run before
    top = F.least(F.col("_by_horizon") + 1, "_by_cap")
    too_late = ((F.col("_last_day") > day) & (F.col("_last_day") > last_day + 1 - F.col("_start"))) | (
        (top >= 0) & (F.col("_last_day") > last_day + 1 - F.col("_next") - top * F.col("_length"))
    )
    checks = (
        F.col("subject_number").isNull(),
        F.col("last_study_visit_date").isNull(),
        F.col("_cycle").isNull() | day.isNull(),
        F.col("_start").isNull(),
        F.col("_next").isNull(),
        too_late,
    )
    reason = F.lit(None).cast("string")
    for name, check in reversed([*zip(REASONS, checks, strict=True)]):
        reason = F.when(check, name).otherwise(reason)
    last_k = F.greatest(F.least("_by_horizon", "_by_cap"), F.lit(-1)).cast("int")
    return rows.withColumns(
        {
            "reason": reason,
            "_last_k": last_k,
            "_current_start": F.date_from_unix_date(F.col("_start").try_cast("int")),
            "_next_start": F.date_from_unix_date(F.col("_next").try_cast("int")),
        }
    ).drop("_pattern", "_start", "_cycle", "_planned", "_next", "_by_horizon", "_by_cap", "_last_day")


def cycle_bounds(plan: DataFrame, params: ForecastParams) -> DataFrame:
    """The plan rows that can be projected, with what ``bounded`` adds."""
    return bounded(plan, params).where("reason IS NULL").drop("reason")


def unprojected(plan: DataFrame, params: ForecastParams) -> DataFrame:
    """Plan rows that cannot be projected, with the first ``reason`` that applies."""
    return bounded(plan, params).where("reason IS NOT NULL").select(*plan.columns, "reason")


def project_visits(plan: DataFrame, params: ForecastParams) -> DataFrame:
    """One row per future visit: the rest of the current cycle, then whole cycles up to the horizon."""
    return visits_of(cycle_bounds(plan, params), params)


def visits_of(bounds: DataFrame, params: ForecastParams) -> DataFrame:
    current = F.col("_k") < 0
    visits = (
        # one expansion over cycles and days together: a row is copied once per visit
        bounds.withColumn("_i", F.explode(F.sequence(F.lit(0), (F.col("_last_k") + 2) * F.size("_days") - 1)))
        .withColumns({"_k": (F.floor(F.col("_i") / F.size("_days")) - 1).cast("int"), "day": F.get("_days", F.col("_i") % F.size("_days"))})
        .drop("_i")
        .withColumn(
            "predicted_next_visit_date",
            F.when(current, F.date_add("_current_start", (F.col("day") - 1).cast("int"))).otherwise(
                F.date_add("_next_start", (F.col("_k") * F.col("_length") + F.col("day") - 1).cast("int"))
            ),
        )
        .where(F.col("predicted_next_visit_date") <= F.lit(params.horizon_date))
        .where(
            ~current
            | (
                (F.col("day") > F.col("parsed_last_visit_day"))
                & (F.col("_cap").isNull() | (F.col("parsed_last_visit_cycle") <= F.col("_cap")))
            )
        )
    )
    cycle = F.when(current, F.col("parsed_last_visit_cycle")).otherwise(F.col("_next_cycle") + F.col("_k"))
    return visits.withColumn("cycle", cycle).withColumn(
        "predicted_study_visit",
        F.concat("_prefix", F.lit("Cycle "), F.col("cycle"), F.lit(" Day "), F.col("day")),
    )


_TYPES = dict(field.split(" ") for field in FORECAST_SCHEMA.split(", "))
# columns of the report's order that a visit has from its plan row; they come first in it
_OF_PLAN = FORECAST_SORT[: FORECAST_SORT.index("cycle")]


def _as_output(name: str) -> Column:
    return F.col(name).try_cast(_TYPES[name]).alias(name)


def in_report_order(bounds: DataFrame, tasks: int) -> DataFrame:
    """Plan rows dealt over ``tasks`` ranges of the report's leading columns, so that sorting their visits within a task sorts all."""
    places = [F.col("study_protocol") if c == "study_name" else F.col(c) for c in _OF_PLAN]
    return bounds.repartitionByRange(
        tasks, *[p.try_cast(_TYPES[c]).asc_nulls_last() for p, c in zip(places, _OF_PLAN, strict=True)]
    )


def shape_output(visits: DataFrame, params: ForecastParams, sort: bool = False) -> DataFrame:
    """The output columns in order and type; ``sort`` puts those of each task in the order of the written report."""
    named = visits.withColumnRenamed("study_protocol", "study_name").withColumn(
        "processed_timestamp", values.moment(params.stamp)
    )
    out = named.select(*[_as_output(c) if c in named.columns else F.lit(None).cast(t).alias(c) for c, t in _TYPES.items()])
    return out.sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in FORECAST_SORT]) if sort else out
