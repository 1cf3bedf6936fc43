"""Tables written once into the shared folder, to cut lineage and to know their size."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a fresh local one only where a local session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="dosecast-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with the writer's ``options``, and return it read back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(frames: Iterable[DataFrame], label: str) -> DataFrame:
    """Write frames of the same columns, at least one, one after the other and return them read back as one.

    A frame is asked for when the one before it is written.
    """
    path = None
    for df in frames:
        spark, schema = df.sparkSession, df.schema
        path = path or fresh_path(spark, label)
        df.write.mode("append").parquet(path)
        # Java keeps a frame, and the files it names, while Python has its proxies; those hang in cycles
        del df
        gc.collect()
    return spark.read.schema(schema).parquet(path)
