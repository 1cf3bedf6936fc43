"""Stored tables: scan and latest snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast import fixed_values as fixed
from dosecast.functions import text, values


def scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet dataset by path."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


# path and number of a CSV row: sorts rows as they stand in the files
FILE_ORDER = "row_in_file"


def _typed_csv(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """CSV with a header line as text, line breaks in quoted cells allowed, and each row's place as ``FILE_ORDER``.

    Missing markers become null, known columns are typed, others kept as text.
    """
    raw = spark.read.options(header="true", escape='"', multiLine="true").csv(path)
    # one task reads a file with line breaks in cells from start to end, so numbers rise within it
    place = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id().alias("row")).alias(FILE_ORDER)
    names = [c.strip() for c in raw.columns]
    raw = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(raw.columns, names, strict=True)], place)
    columns = []
    for name in names:
        cell, kind = text.without_na(f"`{name}`"), types.get(name, "string")
        value = values.parse_date_loose(cell, "string") if kind == "date" else values.typed(cell, kind)
        columns.append(value.alias(name))
    return raw.select(*columns, FILE_ORDER)


def subjects_csv(spark: SparkSession, path: str) -> DataFrame:
    """Subject summary from CSV under table column names."""
    types = {c: kind for c, _, kind in fixed.headers(fixed.SUBJECT_HEADERS)} | {"extract_date": "date"}
    return _typed_csv(spark, path, types)


def mapping_csv(spark: SparkSession, path: str) -> DataFrame:
    """Treatment mapping from CSV under table column names."""
    return _typed_csv(spark, path, {c: kind for c, _, kind in fixed.headers(fixed.TREATMENT_MAPPING_HEADERS)})


def latest_snapshot(df: DataFrame, snapshot_col: str = "processed_timestamp") -> DataFrame:
    """Rows of the latest day in ``snapshot_col``.

    The day comes from a job that reads that column alone. Its start is then a constant lower bound on the bare
    column, so partitions are pruned and row groups skipped.
    """
    day = df.agg(F.max(F.col(snapshot_col)).cast("date").alias("day")).first()["day"]
    start = F.lit(day).cast(dict(df.dtypes)[snapshot_col])
    return df.where(F.col(snapshot_col) >= start)


#: Rows of a table that one task joins and shapes.
SPREAD_ROWS = 250_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a stored table hashed over all cores, or over as many tasks as their number needs, where a scan gives fewer.

    A scan with tasks enough stays as it is, so a large table in many files is not shuffled. The number is read
    off the files' footers.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS))
    return df.repartition(tasks, *keys) if df.rdd.getNumPartitions() < tasks else df
