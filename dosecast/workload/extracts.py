"""Raw extracts made from the driver tables: per-study CSV files in dated folders.

The rows become CSV lines in Spark and are written with one file per date folder, study folder and
name. Folders carry ``key=value`` names, as Spark writes partitions; ``LAYOUT`` reads them. Studies name
their headers differently, order them differently, lack some and add some. Files start with junk lines.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import uuid
from collections.abc import Callable, Iterable
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from dosecast import fixed_values as fixed
from dosecast.operators.conform import KINDS
from dosecast.plans.curate import CurationParams
from dosecast.sources.discovery import FolderChoice, Layout
from dosecast.sources.staging import fresh_path
from dosecast.workload.adapters import table

LAYOUT = Layout(
    pattern=r"/extract=(\d+)/(?:folder=([^/]+)/)?name=([^/]+)/[^/]+$", folder="extract={}", named_files=False
)
PATTERN = r"AA-BB-\d+-\d+"
STAMP = dt.datetime(2024, 3, 1, 6, 0)
STUDIES = 4
DATES = ("20240101", "20240201")
ROWS_PER_FILE = 50_000
KEYS = ("extract", "folder", "name")
#: Files of a few lines that one task writes.
FILES_PER_TASK = 500


def params(root: str, **kw) -> CurationParams:
    return CurationParams(root=root, study_pattern=PATTERN, run_timestamp=STAMP, layout=LAYOUT, **kw)


def every_folder(root: str) -> CurationParams:
    return params(root, choice=FolderChoice(historical=True))


def study_header(header: str, k: int) -> str:
    """Header of a standard column in the files of study ``k``."""
    return header if k == 0 else f"{header} (S{k})"


def header_mapping(spark: SparkSession) -> DataFrame:
    """Wide mapping sheet; study 2 has no investigator, and sources carry stray spaces."""
    rows = [
        (h, *[None if k == 2 and h == "Investigator" else f" {study_header(h, k)} " for k in range(STUDIES)])
        for _, h, _ in KINDS["subject"].fields
    ]
    schema = ", ".join(f"`{c}` string" for c in (fixed.MAPPING_HEADER, *[f"AA-BB-{k}-{k}" for k in range(STUDIES)]))
    return spark.createDataFrame(rows, schema)


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_line(cells: Column) -> Column:
    return F.array_join(cells, ",", "")


def header_line(block: str, k: int, extra: str | None = None) -> str:
    """Header of study ``k``; odd studies have the columns in reverse order."""
    names = [study_header(h, k) for _, h, _ in fixed.headers(block)] if extra else [
        h for _, h, _ in fixed.headers(block)
    ]
    if extra and k == 2:
        names.remove(study_header("Investigator", k))
    names = names + [extra] if extra else names
    return ",".join(names[::-1] if k % 2 else names)


def with_heads(rows: DataFrame, heads: Column, junk: tuple[str, ...] = (",,,,,,,,", "Report of the day")) -> DataFrame:
    """Add junk and header lines to (extract, folder, name, k, ord, line); ``heads`` is the header line."""
    files = rows.select("extract", "folder", "name", "k").distinct()
    first = F.array(
        *[F.struct(F.lit(i - 10).cast("bigint").alias("ord"), F.lit(text).alias("line")) for i, text in enumerate(junk)],
        F.struct(F.lit(-1).cast("bigint").alias("ord"), heads.alias("line")),
    )
    tops = files.withColumn("top", F.explode(first)).select("extract", "folder", "name", "k", "top.ord", "top.line")
    return rows.select("extract", "folder", "name", "k", "ord", "line").unionByName(tops)


def per_study(make: Callable[[int], str]) -> Column:
    """Header line by study number in column ``k``."""
    line = F.when(F.col("k") == 0, make(0))
    for k in range(1, STUDIES):
        line = line.when(F.col("k") == k, make(k))
    return line


def write(rows: DataFrame, label: str) -> str:
    """One file per (extract, folder, name), lines by ``ord``; returns the root."""
    root = fresh_path(rows.sparkSession, label)
    ordered = rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "ord").select(*KEYS, "line")
    ordered.write.partitionBy(*KEYS).text(root)
    return root


def write_small(rows: DataFrame, label: str) -> str:
    """``write`` for very many files of a few lines each: the same folders and lines.

    Files are dealt by their number: by size, all of them would come together in one task. In a local or mounted folder tasks write
    with Python's own calls, since Hadoop's local file system starts a ``chmod`` process for each new folder, file and checksum.
    """
    spark = rows.sparkSession
    root = fresh_path(spark, label)
    rows = rows.withColumns({k: F.nullif(F.col(k), F.lit("")) for k in KEYS})
    tasks = -(-rows.select(*KEYS).distinct().count() // FILES_PER_TASK)
    tasks = max(tasks, spark.sparkContext.defaultParallelism)
    ordered = rows.repartition(tasks, *KEYS).sortWithinPartitions(*KEYS, "ord").select(*KEYS, "line")
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
        folder = at.toUri().getPath()
        os.makedirs(folder)
        ordered.foreachPartition(file_writer(folder))
    else:
        ordered.write.partitionBy(*KEYS).text(root)
    return root


def file_writer(root: str) -> Callable[[Iterable[Row]], None]:
    """Writes rows, sorted by ``KEYS``, below ``root`` as Spark's text writer partitions them. A file appears whole or not at all.

    Its functions are local, so that tasks get them by value and need not import this package.
    """

    def folder_value(value: str | None) -> str:
        escaped = re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda c: f"%{ord(c[0]):02X}", value or "")
        return escaped or "__HIVE_DEFAULT_PARTITION__"

    def write_rows(rows: Iterable[Row]) -> None:
        for keys, lines in groupby(rows, key=lambda row: tuple(row[k] for k in KEYS)):
            folder = os.path.join(root, *[f"{k}={folder_value(v)}" for k, v in zip(KEYS, keys, strict=True)])
            os.makedirs(folder, exist_ok=True)
            hidden = os.path.join(folder, f".{uuid.uuid4().hex}")
            with open(hidden, "w", encoding="utf-8", newline="") as file:
                file.writelines(f"{row['line'] or ''}\n" for row in lines)
            os.replace(hidden, os.path.join(folder, "part-00000.txt"))

    return write_rows


_written: dict[tuple[str, str, str], str] = {}


def once(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    make: Callable[[], DataFrame],
    writer: Callable[[DataFrame, str], str] = write,
) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        _written[key] = writer(make(), label)
    return _written[key]


def _placed(df: DataFrame, key: str, kind: str, reverse_odd: bool = True) -> DataFrame:
    """Place rows with ``cells`` into files of study key % 4."""
    part = F.floor(F.col(key) / ROWS_PER_FILE).cast("string")
    k = F.col("k").cast("string")
    cells = F.when(F.col("k") % 2 == 1, F.reverse("cells")).otherwise(F.col("cells")) if reverse_odd else F.col("cells")
    return df.select(
        "extract",
        F.concat(F.lit("study "), k, F.lit("-"), part).alias("folder"),
        F.concat(F.lit("Acme AA-BB-"), k, F.lit("-"), k, F.lit("_" + kind + " "), part, F.lit(".csv")).alias("name"),
        F.col("k").cast("int").alias("k"),
        F.col(key).cast("bigint").alias("ord"),
        csv_line(cells).alias("line"),
    )


def text_of(name: str) -> Column:
    return F.col(name).cast("string")


# ---- subject summaries: customers -------------------------------------------------------------


def subject_extracts(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "subject-extracts", lambda: _subject_lines(spark, sf_dir))


def _subject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_d"))
    people = (
        table(spark, sf_dir, "customer")
        .join(last, F.col("o_custkey") == F.col("c_custkey"), "left")
        .withColumn("k", F.col("c_custkey") % STUDIES)
        .withColumn("extract", F.explode(F.array(*[F.lit(d) for d in DATES])))
    )
    key = F.col("c_custkey")
    # study 3 has line breaks in cells
    investigator = F.concat("c_name", F.when(F.col("k") == 3, ',\n"MD"').otherwise(', "MD"'))
    written = F.when(key % 2 == 0, F.date_format("last_d", "dd-MMM-yyyy")).otherwise(F.date_format("last_d", "d MMM yyyy"))
    cell = {
        "Site ID": F.when(key % 9 == 0, "N/A").when(key % 5 == 0, F.concat(text_of("c_nationkey"), F.lit(".0")))
        .otherwise(text_of("c_nationkey")),
        "Country": F.when(key % 7 == 0, "nan").otherwise(F.concat(F.lit("Land "), text_of("c_nationkey"))),
        "Parent Depot": F.lit("unknown"),
        "Investigator": quoted(investigator),
        "Subject Number": text_of("c_custkey"),
        "Year of Birth": (F.lit(1950) + key % 50).cast("string"),
        "TPC": quoted(F.col("c_mktsegment")),
        "Date Randomized": F.lit("31-DEC-2023"),
        "Subject Status": F.lit("Randomized"),
        "Last Study Visit Date": F.when(key % 6 == 0, "soon").otherwise(written),
    }
    names = [h for _, h, _ in KINDS["subject"].fields]
    cells = [cell.get(h, F.lit("")) for h in names]
    full = F.array(*cells, F.lit("not wanted"))
    short = F.array(*[c for h, c in zip(names, cells, strict=True) if h != "Investigator"], F.lit("not wanted"))
    rows = people.withColumn("cells", F.when(F.col("k") == 2, short).otherwise(full))
    heads = per_study(lambda k: header_line(fixed.SUBJECT_HEADERS, k, extra="Not Mapped"))
    return with_heads(_placed(rows, "c_custkey", "Subject Summary"), heads)


# ---- inventories and supply methods -----------------------------------------------------------


def site_extracts(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "site-extracts", lambda: _site_lines(spark, sf_dir))


def _site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").withColumn("k", key % STUDIES).withColumn("extract", F.lit(DATES[1]))
    number = {h: (key % (i + 7)).cast("string") for i, (_, h, t) in enumerate(fixed.headers(fixed.SITE_HEADERS)) if t == "bigint"}
    cell = {
        "Site ID": text_of("o_custkey"),
        "Country": F.when(key % 4 != 1, F.concat(F.lit("Land "), (key % 25).cast("string"))),
        "Parent Depot": (key % 5).cast("string"),
        "Study Drug Type": F.col("o_orderstatus"),
        "Unblinded Study Drug Name": quoted(F.concat("o_orderpriority", F.lit(", 10mg"))),
        "FP Expiry Date": F.date_format("o_orderdate", "dd-MMM-yyyy"),
        **number,
    }
    rows = rows.withColumn("cells", F.array(*[cell.get(h, F.lit("")) for _, h, _ in fixed.headers(fixed.SITE_HEADERS)]))
    heads = per_study(lambda k: header_line(fixed.SITE_HEADERS, k))
    return with_heads(_placed(rows, "o_orderkey", "Site Inventory"), heads)


def depot_extracts(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "depot-extracts", lambda: _depot_lines(spark, sf_dir))


def _depot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").withColumn("k", key % STUDIES).withColumn("extract", F.lit(DATES[1]))
    cell = {
        "Depot ID": text_of("p_size"),
        "Depot Type": F.col("p_type"),
        "Unblinded Study Drug Name": quoted(F.col("p_name")),
        "Part Number": F.col("p_brand"),
        "Quantity Study Drug - Available": F.when(key % 3 == 0, "none").otherwise(text_of("p_partkey")),
        "Quantity Study Drug - Total": text_of("p_partkey"),
        "Approved Countries": quoted(F.lit("A, B")),
    }
    rows = rows.withColumn("cells", F.array(*[cell.get(h, F.lit("")) for _, h, _ in fixed.headers(fixed.DEPOT_HEADERS)]))
    heads = per_study(lambda k: header_line(fixed.DEPOT_HEADERS, k))
    return with_heads(_placed(rows, "p_partkey", "Depot Inventory"), heads)


def site_supply_extracts(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "site-supply-extracts", lambda: _site_supply_lines(spark, sf_dir))


def _site_supply_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").withColumn("k", key % STUDIES).withColumn("extract", F.lit(DATES[1]))
    cells = F.array(
        F.concat(F.lit("Land "), text_of("s_nationkey")),
        F.concat(F.lit("00"), text_of("s_suppkey")),
        F.col("s_name"),
        F.when(key % 2 == 0, "central").otherwise("local"),
        F.lit("Open"),
    )
    heads = per_study(lambda k: header_line(fixed.SITE_SUPPLY_HEADERS, k))
    return with_heads(_placed(rows.withColumn("cells", cells), "s_suppkey", "Site SupplyMethod"), heads)


def document_extracts(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "document-extracts", lambda: _document_lines(spark, sf_dir))


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country-level supply files whose comparator names are whole documents, line breaks and all."""
    rows = (
        table(spark, sf_dir, "documents")
        .withColumn("k", F.col("doc_id") % STUDIES)
        .withColumn("extract", F.lit(DATES[1]))
        .withColumn("cells", F.array(F.col("lang"), quoted(F.col("text")), text_of("doc_id")))
    )
    heads = per_study(lambda k: header_line(fixed.COUNTRY_SUPPLY_HEADERS, k))
    return with_heads(_placed(rows, "doc_id", "Country SupplyMethod"), heads)


def faulty_extracts(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "faulty-extracts", lambda: _faulty_lines(spark, sf_dir), write_small)


def _faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-level supply files, one per supplier, most of them with a fault."""
    key = F.col("s_suppkey")
    fault = key % 5
    number = text_of("s_suppkey")
    study = F.when(fault == 1, "AA-BB-x-1").otherwise(F.concat(F.lit("AA-BB-"), number, F.lit("-1")))
    rows = table(spark, sf_dir, "supplier").select(
        F.lit(DATES[1]).alias("extract"),
        F.concat(F.lit("folder "), number).alias("folder"),
        F.concat(F.lit("Acme "), study, F.lit("_"), number, F.lit(" Site SupplyMethod.csv")).alias("name"),
        fault.cast("int").alias("k"),
        F.lit(1).cast("bigint").alias("ord"),
        F.concat(
            F.lit("Land,"), number, F.lit(","),
            F.when(fault == 3, F.concat(F.lit('"'), "s_name")).otherwise(F.col("s_name")),
            F.lit(",central,Open"), F.when(fault == 4, ",surplus").otherwise(""),
        ).alias("line"),
    )
    head = F.when(F.col("k") == 2, "only one cell").otherwise(header_line(fixed.SITE_SUPPLY_HEADERS, 0))
    # a fault-2 file has blank cells in every line of its first ten
    blanks = rows.where("k = 2").withColumn("ord", F.explode(F.sequence(F.lit(-9), F.lit(0))))
    blanks = blanks.withColumns({"ord": F.col("ord").cast("bigint"), "line": F.lit(",,")})
    return with_heads(rows, head, junk=()).unionByName(blanks)
