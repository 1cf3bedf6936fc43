"""Catalog tables whose rows, or date partitions, are replaced at once.

New rows are written to a folder of their own below ``folder``; only when all files are there does the catalog point the table,
or each partition, to them. A reader that has begun, and every reader after a write that failed, sees the old rows whole. The
rows to write may come from the table itself. Old folders stay for readers under way; ``data_folders`` tells which are in use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _check_columns(df: DataFrame, name: str) -> None:
    have, want = df.sparkSession.table(name).dtypes, df.dtypes
    if sorted(have) != sorted(want):
        raise ValueError(f"table {name} has columns {have}, not {want}")


def replace_table(df: DataFrame, name: str, folder: str, file_format: str = "parquet") -> str:
    """Replace all rows of table ``name``, or create it. Gives the folder of the new files.

    Columns and types must be those of the table; their order is the table's.
    """
    spark, path = df.sparkSession, f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    exists = spark.catalog.tableExists(name)
    if exists:
        _check_columns(df, name)
    df.write.format(file_format).save(path)
    if exists:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path, file_format, df.schema)
    return path


def replace_partitions(df: DataFrame, name: str, folder: str, file_format: str = "parquet", column: str = "extract_date") -> str:
    """Replace the partitions of table ``name`` that occur in ``df`` and leave all others; create the table if there is none.

    ``column`` is a date, so the partitions of a write are calendar days: few enough to be named one by one. A row without
    a date is an error, found before any partition changes. Each partition changes at once, one after the other.
    """
    spark, path = df.sparkSession, f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    if dict(df.dtypes).get(column) != "date":
        raise TypeError(f"{column} must be a date")
    exists = spark.catalog.tableExists(name)
    if exists:
        _check_columns(df, name)
    df.hint("rebalance", column).write.format(file_format).partitionBy(column).save(path)
    # the days are in the names of the folders, so no file is read for them
    written = spark.read.format(file_format).schema(df.schema).load(path)
    days = sorted((r[column] for r in written.select(column).distinct().collect()), key=str)
    if None in days:
        raise ValueError(f"rows without {column}")
    if not exists:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING {file_format} PARTITIONED BY (`{column}`) "
            f"LOCATION {_quoted(folder.rstrip('/') + '/none')}"
        )
    for day in days:
        place, one = _quoted(f"{path}/{column}={day}"), f"PARTITION (`{column}` = DATE'{day}')"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {one} LOCATION {place}")
        spark.sql(f"ALTER TABLE {name} {one} SET LOCATION {place}")
    spark.catalog.refreshTable(name)
    return path


def data_folders(spark: SparkSession, name: str) -> DataFrame:
    """Folders that hold the files of the table now (column ``folder``)."""
    return spark.table(name).select(F.regexp_replace("_metadata.file_path", "/[^/]+$", "").alias("folder")).distinct()
