"""Joins of a large fact side with a mapping side that is usually, but not surely, small."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64
#: Distinct keys that the heavy-hitter sketch follows; its counts are off by a small multiple of rows / TRACKED at most.
TRACKED = 10_000


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows written as JSON, field names included: more than a broadcast of them holds."""
    row = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).cast("bigint")
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def hot_keys(facts: DataFrame, key: Column) -> list[int]:
    """Values of ``key`` (a hash) that hold more rows than an even shuffle partition would, by a heavy-hitter sketch.

    One pass over the key columns, and at most as many values as there are shuffle partitions. The sketch merges, so
    it is of the same size for any number of rows.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.call_function("approx_top_k", key, F.lit(min(partitions, TRACKED)), F.lit(TRACKED))
    row = facts.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [item["item"] for item in row["top"] or [] if item["count"] * partitions > row["n"]]


def _hash(columns: Iterable[Column]) -> Column:
    # as text, so that equal keys of different integer types have the same hash
    return F.xxhash64(*[c.cast("string") for c in columns])


def salted_sides(
    facts: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, Column],
    sketched: tuple[DataFrame, Mapping[str, Column]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``facts`` with a column ``_salt`` and ``dim`` with ``_dim_salt``: 0 for most keys; for hot ones facts are dealt
    over ``SALTS`` salts and ``dim`` rows are copied to each."""
    source, known = sketched or (facts, keys)
    hot = hot_keys(source, _hash(known.values()))
    fact_hash, dim_hash = _hash(keys[name] for name in known), _hash(F.col(name) for name in known)
    if not hot:
        return facts.withColumn("_salt", F.lit(0)), dim.withColumn("_dim_salt", F.lit(0))
    dealt = F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int")
    every, one = F.sequence(F.lit(0), F.lit(SALTS - 1)), F.array(F.lit(0))
    return (
        facts.withColumn("_salt", F.when(fact_hash.isin(hot), dealt).otherwise(0)),
        dim.withColumn("_dim_salt", F.explode(F.when(dim_hash.isin(hot), every).otherwise(one))),
    )


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, Column],
    how: str = "inner",
    residual: Column | None = None,
    max_bytes: int = 64 * 1024 * 1024,
    sketched: tuple[DataFrame, Mapping[str, Column]] | None = None,
) -> DataFrame:
    """Null-safe join of ``facts`` with ``dim`` on ``dim`` column = fact expression.

    ``how`` is inner, left, left_semi or left_anti, always seen from the facts. A ``dim`` of at most ``max_bytes``
    (measured by a job of its own, not estimated) is broadcast, so the facts stay where they are. A larger one is
    joined by shuffle, which a hint holds Spark to: matching keys are few, so one of them may hold a large part of the facts. A sketch
    of the facts finds such keys; their fact rows take one of ``SALTS`` salts each and their ``dim`` rows appear under all of
    them, which spreads a hot key over that many tasks and leaves the result unchanged. All other rows stay single. A key that
    the sketch passes over costs balance, not rows, and the adaptive skew join splits further. ``sketched`` names another
    frame to look for hot keys in, with some of the keys as it has them, where ``facts`` are a join that would run twice.
    ``dim`` must use column names that ``facts`` does not have.
    """
    condition = None
    for name, fact in keys.items():
        equal = fact.eqNullSafe(F.col(name))
        condition = equal if condition is None else condition & equal
    if residual is not None:
        condition = condition & residual
    if measured_bytes(dim) <= max_bytes:
        return facts.join(F.broadcast(dim), condition, how)
    salted, copies = salted_sides(facts, dim, keys, sketched)
    joined = salted.join(copies.hint("merge"), condition & (F.col("_salt") == F.col("_dim_salt")), how)
    return joined.drop("_salt", "_dim_salt")
