"""Demand per depot, site or study by drug and month; schedule of one subject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = {"depot": "parent_depot", "site": "site_id", "study": "study_name"}
_SUBJECT = ("study_name", "subject_number")


def _by_month(forecast_rows: DataFrame) -> DataFrame:
    return forecast_rows.withColumn("month", F.trunc("predicted_next_visit_date", "month"))


def _subject_months(forecast_rows: DataFrame, *levels: str) -> DataFrame:
    """One row per subject, ``levels``, drug and month. A subject number is unique within its study only.

    A forecast sits by study and subject, so this needs no shuffle, and what follows counts rows in place of distinct subjects.
    """
    keys = dict.fromkeys((*_SUBJECT, *levels, "drug_dispensed", "month"))
    return _by_month(forecast_rows).groupBy(*keys).agg(
        F.sum("dispensing_quantity").alias("_quantity"), F.count(F.lit(1)).alias("_visits")
    )


def _totals() -> list[Column]:
    """Measures out of one row per subject and cell."""
    return [
        F.sum("_quantity").cast("bigint").alias("quantity"),
        F.sum("_visits").alias("n_visits"),
        F.count(F.lit(1)).alias("n_subjects"),
    ]


def demand(forecast_rows: DataFrame, level: str) -> DataFrame:
    """Quantity, visits and subjects per ``level``, drug and month."""
    rows = _subject_months(forecast_rows, LEVELS[level])
    return rows.groupBy(LEVELS[level], "drug_dispensed", "month").agg(*_totals())


def demand_all_levels(forecast_rows: DataFrame) -> DataFrame:
    """The three rollups in one pass over the forecast; ``level`` tells them apart.

    Visits become one row per subject, depot, site, drug and month, and then one per subject and cell of each level, all where
    the subject is. Only sums per cell and task are shuffled.
    """
    rows = _subject_months(forecast_rows, *LEVELS.values())
    cell = F.explode(F.array(*[
        F.struct(F.lit(name).alias("level"), *[
            (F.col(c) if LEVELS[name] == c else F.lit(None).cast(kind)).alias(f"_{c}")
            for c, kind in rows.select(*LEVELS.values()).dtypes
        ])
        for name in LEVELS
    ]))
    cells = [f"_{c}" for c in LEVELS.values()]
    each = rows.select(*_SUBJECT, "drug_dispensed", "month", "_quantity", "_visits", cell.alias("_cell"))
    each = each.select("*", "_cell.*").drop("_cell")
    per_subject = each.groupBy(*_SUBJECT, "drug_dispensed", "month", "level", *cells).agg(
        F.sum("_quantity").alias("_quantity"), F.sum("_visits").alias("_visits")
    )
    out = per_subject.groupBy("level", *cells, "drug_dispensed", "month").agg(*_totals())
    return out.withColumnsRenamed({f"_{c}": c for c in LEVELS.values()})


def _by_level(rows: DataFrame, measures: list[Column], more: tuple[str, ...] = ()) -> DataFrame:
    """Measures by level, drug, month and ``more`` columns; ``rows`` have a column ``study`` beside ``study_name``."""
    own = ["parent_depot", "site_id", "study"]
    shared = ["drug_dispensed", "month", *more]
    columns = own + shared
    grouped = rows.groupingSets([[F.col(k) for k in [c, *shared]] for c in own], *[F.col(c) for c in columns]).agg(
        F.shiftright(F.grouping_id(*columns), len(shared)).alias("_gid"), *measures
    )
    # bit of a column is set when the grouping set leaves it out
    level = F.when(F.col("_gid") == 0b011, "depot").when(F.col("_gid") == 0b101, "site").otherwise("study")
    named = grouped.columns[len(columns) + 1 :]
    out = grouped.withColumn("level", level).withColumnRenamed("study", "study_name")
    return out.select("level", *LEVELS.values(), *shared, *named)


# ---- rollups that grow by parts -----------------------------------------------------------------

#: Visits of a part that one task counts.
VISITS = 500_000
_CELL = ("level", *LEVELS.values(), "drug_dispensed", "month")


def number_subjects(forecast_rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """study_name, subject_number, number: the ``known`` ones, then the new ones under numbers of their own.

    Store the result before it is used: numbers are given where a task stands. Subjects of a study and site come one after
    the other, so that their bits lie close together.
    """
    new = forecast_rows.groupBy(*_SUBJECT).agg(F.min("site_id").alias("_site"))
    start = F.lit(1).cast("bigint")
    if known is not None:
        new = new.join(known, [new[c].eqNullSafe(known[c]) for c in _SUBJECT], "left_anti")
        start = F.coalesce(known.agg(F.max("number")).scalar(), F.lit(0)).cast("bigint") + 1
    numbered = new.orderBy("study_name", "_site", "subject_number").select(
        *_SUBJECT, (start + F.monotonically_increasing_id()).alias("number")
    )
    return numbered if known is None else known.select(*_SUBJECT, "number").unionByName(numbered)


def demand_part(forecast_rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """The three rollups of some visits as a part that merges with others: sums, and subjects as bitmaps of their numbers.

    A row holds the subjects of one bucket of 32,768 numbers, so no bitmap grows beyond 4 KB. Stored visits may come in splits
    of any number of rows, so they are counted and dealt over as many tasks as that needs, by subject and again by the
    cells that bitmaps are made for.
    """
    spark = forecast_rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-forecast_rows.count() // VISITS))
    subject_months = _subject_months(forecast_rows.repartition(tasks, *_SUBJECT), *LEVELS.values())
    wanted = numbers.select(F.col("study_name").alias("_study"), F.col("subject_number").alias("_subject"), "number")
    same = F.col("study_name").eqNullSafe(F.col("_study")) & F.col("subject_number").eqNullSafe(F.col("_subject"))
    rows = subject_months.join(wanted, same).select(
        *LEVELS.values(), F.col("study_name").alias("study"), "drug_dispensed", "month", "_quantity", "_visits",
        F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("_bit"),
    )
    measures = [
        F.sum("_quantity").cast("bigint").alias("quantity"),
        F.sum("_visits").alias("n_visits"),
        F.bitmap_construct_agg("_bit").alias("subjects"),
    ]
    return _by_level(rows.repartition(tasks, "bucket", "drug_dispensed", "month"), measures, ("bucket",))


def merge_demand(parts: DataFrame) -> DataFrame:
    """Parts of visits that do not overlap, put together by union, as one part. Their subjects may overlap."""
    return parts.groupBy(*_CELL, "bucket").agg(
        F.sum("quantity").alias("quantity"), F.sum("n_visits").alias("n_visits"), F.bitmap_or_agg("subjects").alias("subjects")
    )


def demand_of_part(part: DataFrame) -> DataFrame:
    """What ``demand_all_levels`` gives for all visits of a merged part; subjects are counted exactly."""
    return part.groupBy(*_CELL).agg(
        F.sum("quantity").alias("quantity"),
        F.sum("n_visits").alias("n_visits"),
        F.sum(F.bitmap_count("subjects")).alias("n_subjects"),
    )


def subject_schedule(forecast_rows: DataFrame, subject_number: Column | int) -> DataFrame:
    """Visits of one subject in date order."""
    return forecast_rows.where(F.col("subject_number") == subject_number).orderBy(
        "predicted_next_visit_date", "study_name", "drug_dispensed", "cycle", "day"
    )
