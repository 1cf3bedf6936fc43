import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from dosecast.operators import rollup
from dosecast.sources import catalog

DAYS = [dt.date(2025, 1, d) for d in (1, 2, 3)]


def rows(spark, days, value):
    return spark.createDataFrame([(i, value, d) for d in days for i in range(3)], "k int, v string, extract_date date")


def seen(df):
    return sorted((r["extract_date"].day, r["v"]) for r in df.select("extract_date", "v").distinct().collect())


@pytest.fixture
def place(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    yield name, str(tmp_path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_partitions_are_replaced_at_once(spark, place):
    name, folder = place
    catalog.replace_partitions(rows(spark, DAYS, "old"), name, folder)
    before = spark.table(name)
    before.count()
    catalog.replace_partitions(rows(spark, DAYS[1:2], "new"), name, folder)
    assert seen(spark.table(name)) == [(1, "old"), (2, "new"), (3, "old")]
    assert spark.table(name).where(F.col("extract_date") == DAYS[1]).count() == 3
    assert catalog.data_folders(spark, name).count() == 3
    # a failed write and a row without a date change nothing
    broken = rows(spark, DAYS, "broken").withColumn("v", F.when(F.col("k") < 2, F.col("v")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        catalog.replace_partitions(broken, name, folder)
    undated = rows(spark, DAYS, "undated").withColumn("extract_date", F.when(F.col("k") > 0, F.col("extract_date")))
    with pytest.raises(ValueError, match="without"):
        catalog.replace_partitions(undated, name, folder)
    assert seen(spark.table(name)) == [(1, "old"), (2, "new"), (3, "old")]


def test_no_rows_and_other_columns(spark, place):
    name, folder = place
    catalog.replace_partitions(rows(spark, [], ""), name, folder)
    assert spark.table(name).count() == 0
    catalog.replace_partitions(rows(spark, DAYS[:1], "a"), name, folder)
    catalog.replace_partitions(rows(spark, [], ""), name, folder)
    assert seen(spark.table(name)) == [(1, "a")]
    with pytest.raises(ValueError, match="columns"):
        catalog.replace_partitions(rows(spark, DAYS, "b").drop("v"), name, folder)
    with pytest.raises(TypeError):
        catalog.replace_partitions(rows(spark, DAYS, "b").withColumn("extract_date", F.lit("x")), name, folder)


def test_whole_table_while_a_reader_holds_it(spark, place):
    name, folder = place
    catalog.replace_table(rows(spark, DAYS, "old"), name, folder)
    reader = spark.table(name)
    plan = reader.groupBy("v").count()
    # the rows come from the table itself, in another order of columns
    catalog.replace_table(reader.select("extract_date", F.lit("new").alias("v"), "k"), name, folder)
    assert [tuple(r) for r in spark.table(name).groupBy("v").count().collect()] == [("new", 9)]
    assert [tuple(r) for r in plan.collect()] == [("old", 9)]
    with pytest.raises(Exception, match="lost"):
        catalog.replace_table(spark.table(name).withColumn("v", F.raise_error(F.lit("lost")).cast("string")), name, folder)
    assert spark.table(name).where("v = 'new'").count() == 9


VISITS = "study_name string, parent_depot bigint, site_id bigint, subject_number bigint, drug_dispensed string, " \
    "predicted_next_visit_date date, dispensing_quantity bigint"  # fmt: skip


def visits(spark, n, start):
    """Nulls in every column, repeated rows, subjects of one number in two studies."""
    made = []
    for i in range(start, start + n):
        made.append((
            None if i % 11 == 0 else f"S{i % 2}", None if i % 7 == 0 else i % 3, None if i % 5 == 0 else i % 4,
            None if i % 13 == 0 else i % 17, None if i % 19 == 0 else f"D{i % 2}", dt.date(2025, 1 + i % 2, 1 + i % 28),
            None if i % 3 == 0 else i % 5,
        ))
    return spark.createDataFrame(made + made[:3], VISITS)


def test_rollups_by_parts_equal_the_whole(spark):
    from dosecast.sources.staging import stage

    days = [visits(spark, 150, 0), visits(spark, 80, 90), visits(spark, 0, 0).where("false"), visits(spark, 40, 1000)]
    numbers = part = everything = None
    for day in days:
        numbers = stage(rollup.number_subjects(day, numbers), "numbers")
        new = rollup.demand_part(day, numbers)
        part = stage(new if part is None else rollup.merge_demand(part.unionByName(new)), "part")
        everything = day if everything is None else everything.unionByName(day)
    assert numbers.count() == numbers.select("number").distinct().count() == everything.select("study_name", "subject_number").distinct().count()
    key = lambda r: [str(x) for x in r]
    got = sorted(rollup.demand_of_part(part).collect(), key=key)
    want = sorted(rollup.demand_all_levels(everything).collect(), key=key)
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
