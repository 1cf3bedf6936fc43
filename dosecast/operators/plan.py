"""One plan row per study, subject and drug."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dosecast.functions import text
from dosecast.operators import match
from dosecast.sources.staging import stage

PLAN_KEYS = ("study_protocol", "subject_number", "drug_dispensed")
TOTAL = "total_medicines_required_per_cycle"

_ORDER = ("tier", "_subject_order", "_mapping_order")
# those of a row, filled or not, so their first value is that of the first row
_FIRST_ROW = ("visit_count_per_cycle", "parsed_last_visit_cycle", "parsed_last_visit_day")
#: Subjects that one task plans and projects, some plan rows and a hundred visits or more each, and rows of them that it matches.
SUBJECTS, SUBJECT_ROWS = 5_000, 40_000
# subject rows that a row stands for
_ROWS = "_subject_rows"


def first_by_nulls(people: DataFrame) -> DataFrame:
    """Subject rows, one per study, subject, match keys and set of filled columns: the first, with their number.

    Rows with the same match keys meet the same mapping rows. A plan column's first non-null value is in the first of the rows
    that fill the same columns as its row does, so no other row is needed. One comparison of whole rows finds it; it
    combines on the map side and before the match, so a subject with very many rows reaches the shuffle as few rows per
    task. Where orders are equal, the values decide.
    """
    keys = ("study_protocol", "subject_number", *match.SUBJECT_KEYS, "_s_country")
    firsts = [c for c in _FIRST_ROW if c in people.columns]
    others = [c for c in people.columns if c not in (*keys, *firsts, "_subject_order")]
    filled = F.array(*[F.col(c).isNotNull() for c in others])
    row = F.struct("_subject_order", *firsts, *others)
    return (
        people.groupBy(*keys, filled.alias("_filled"))
        .agg(F.count(F.lit(1)).alias(_ROWS), F.min(row).alias("_row"))
        .select(*keys, _ROWS, "_row.*")
    )


def deal(people: DataFrame) -> tuple[DataFrame, int]:
    """The rows of ``first_by_nulls``, all of a study and subject in one of as many tasks as their number needs; that number.

    They are stored and counted. A broadcast match leaves them where they are, so neither plan, projection nor
    what is counted per subject moves the rows that come out of a match again.
    """
    rows = stage(first_by_nulls(people), "subjects")
    subject = F.approx_count_distinct(F.struct("study_protocol", "subject_number"))
    seen = rows.agg(F.count(F.lit(1)).alias("rows"), subject.alias("subjects")).first()
    wanted = max(-(-seen["subjects"] // SUBJECTS), -(-seen["rows"] // SUBJECT_ROWS))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, wanted)
    return rows.repartition(tasks, "study_protocol", "subject_number"), tasks


def plan_rows(with_drug: DataFrame) -> DataFrame:
    """Sum of the quantity per cycle; every other column its first non-null value.

    First means: country rows before generic rows, then the subject order, then the mapping order. The rows of a key are
    sorted once, and every column takes its first value there.
    """
    known = (*PLAN_KEYS, *_ORDER, *_FIRST_ROW, TOTAL, _ROWS, "subject_country")
    others = [c for c in with_drug.columns if c not in known]
    quantity = F.col(TOTAL) * F.col(_ROWS) if _ROWS in with_drug.columns else F.col(TOTAL)
    by_key = W.partitionBy(*PLAN_KEYS).orderBy(*_ORDER, *_FIRST_ROW, *others)
    whole = by_key.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    firsts = with_drug.select(
        *PLAN_KEYS,
        F.coalesce(F.sum(quantity).over(whole), F.lit(0)).cast("bigint").alias(TOTAL),
        *[F.first(c).over(whole).alias(c) for c in _FIRST_ROW],
        *[F.first(c, ignorenulls=True).over(whole).alias(c) for c in others],
        F.row_number().over(by_key).alias("_at"),
    )
    plan = firsts.where("_at = 1")
    visit = F.col("last_study_visit_recorded")
    return plan.select(
        *PLAN_KEYS,
        TOTAL,
        *others,
        *_FIRST_ROW,
        F.col("country").alias("subject_country"),
        text.mentions(visit, "crossover").alias("is_crossover"),
        text.mentions(visit, "tpc").alias("is_tpc"),
    )
