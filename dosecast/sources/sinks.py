"""Writes: one date partition, a whole table, CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_partitions(df: DataFrame, path: str, file_format: str = "parquet", column: str = "extract_date") -> None:
    """Replace the partitions that occur in ``df`` and leave all others. No rows, no write.

    Rows of a partition come together first, split where there are many, so tasks do not each write a file per date.
    """
    (
        df.hint("rebalance", column)
        .write.format(file_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .save(path)
    )


def write_whole(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Replace the whole table."""
    df.write.format(file_format).mode("overwrite").save(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV files with a header line each. Visits repeat their plan row's cells, so ``gzip`` leaves a small part of a forecast."""
    df.write.mode("overwrite").options(header="true", compression=compression).csv(path)
