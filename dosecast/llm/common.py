"""What the operators of this package share: tables, free column names, code on executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.sources.staging import fresh_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()
_loaded: dict[tuple, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make this package importable on executors and keep Arrow batches small next to long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    context = spark.sparkContext
    here = str(ROOT) in os.environ.get("PYTHONPATH", "").split(":")
    here = here or (context.master.startswith("local[") and Path.cwd() == ROOT)
    if here or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="dosecast-code-")) / "dosecast.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in (ROOT / "dosecast").rglob("*.py"):
            out.write(path, path.relative_to(ROOT))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def loaded(make: Callable, *args):
    """``make(*args)`` once per Python process."""
    key = (make.__module__, make.__qualname__, *args)
    if key not in _loaded:
        _loaded[key] = make(*args)
    return _loaded[key]


def bucketed(df: DataFrame, label: str, column: str) -> DataFrame:
    """``df`` written to the shared folder in buckets by ``column`` and read back, so that a join on it moves the other side alone.

    There are as many buckets as shuffle partitions. The catalog holds the table only until it is read: its files are
    outside the warehouse, so they stay when the name goes.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).option("path", fresh_path(spark, label)).saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the text alone, the text never null."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def id_type(docs: DataFrame, id_col: str = "doc_id") -> str:
    return dict(docs.dtypes)[id_col]


def texts_of(batch, name: str = "text") -> Iterator[str]:
    """Texts of an Arrow batch one at a time; null is empty."""
    return (value.as_py() or "" for value in batch.column(name))
