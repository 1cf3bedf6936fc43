"""The shuffle route of the size-checked join under a hot key."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from dosecast.operators import joins


@pytest.fixture(scope="module")
def keys(spark):
    return {"k": F.col("a"), "m": F.col("b")}


@pytest.fixture(scope="module")
def sides(spark):
    # a third of the rows under one key, another third under a key with a null, the rest thin
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 8).otherwise(F.col("id")).cast("int")
    facts = spark.range(6000).select("id", key.alias("a"), F.when(F.col("id") % 3 != 1, F.lit("x")).alias("b"))
    dim = spark.range(400).select(F.col("id").alias("k"), F.when(F.col("id") != 8, F.lit("x")).alias("m"), (F.col("id") * 2).alias("v"))
    return facts, dim.union(dim.where("k = 7"))


def test_hot_keys_are_dealt_out_and_cold_rows_are_not_copied(sides, keys):
    facts, dim = sides
    salted, copies = joins.salted_sides(facts, dim, keys)
    assert copies.count() == 398 + (2 + 1) * joins.SALTS
    of_key = {r.a: r.n for r in salted.groupBy("a").agg(F.count_distinct("_salt").alias("n")).collect()}
    assert of_key.pop(7) == joins.SALTS and of_key.pop(8) == joins.SALTS and set(of_key.values()) == {1}
    per_task = salted.where("a = 7").groupBy("_salt").count().agg(F.max("count")).first()[0]
    assert per_task < 2000 / joins.SALTS * 2


def test_without_hot_keys_nothing_is_copied(spark, keys):
    facts = spark.range(5000).select((F.col("id") % 1000).alias("a"), F.lit("x").alias("b"))
    dim = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("m"))
    assert joins.hot_keys(facts, F.xxhash64("a")) == []
    assert joins.salted_sides(facts, dim, keys)[1].count() == 1000
    assert joins.hot_keys(facts.where("false"), F.xxhash64("a")) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_both_routes_agree(sides, keys, how):
    facts, dim = sides
    residual = F.col("id") % 5 != F.col("v") % 5
    small = joins.dimension_join(facts, dim, keys, how, residual)
    large = joins.dimension_join(facts, dim, keys, how, residual, max_bytes=0)
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.select(*small.columns).collect()))
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_hot_keys_of_another_frame(sides, keys):
    facts, dim = sides
    other = facts.where("a = 7").select(F.col("a").alias("other"))
    salted, copies = joins.salted_sides(facts, dim, keys, (other, {"k": F.col("other")}))
    assert copies.count() == 399 + 2 * joins.SALTS
    assert salted.where("a <> 7 AND _salt <> 0").isEmpty()
