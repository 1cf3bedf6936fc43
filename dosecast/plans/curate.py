"""Dated folders of extracts to conformed tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.fixed_values import STUDY_HEADER
from dosecast.functions import text, values
from dosecast.operators import conform as shaping
from dosecast.operators.joins import dimension_join
from dosecast.sources import catalog, discovery, ragged_csv, sinks
from dosecast.sources.discovery import FolderChoice, Layout
from dosecast.sources.staging import stage


@dataclass(frozen=True)
class CurationParams:
    """``study_pattern`` is the regular expression of a study protocol in a file name."""

    root: str
    study_pattern: str
    run_timestamp: dt.datetime
    choice: FolderChoice = FolderChoice()
    layout: Layout = Layout()
    latest_only: bool = True
    max_header_rows: int = ragged_csv.MAX_HEADER_ROWS
    whole_bytes: int = ragged_csv.WHOLE_BYTES


@dataclass(frozen=True)
class Curated:
    """``rows`` of the target table, ``rejected`` files (path, name, error), ``cast_failures`` per column."""

    rows: DataFrame
    rejected: DataFrame
    cast_failures: DataFrame


@dataclass(frozen=True)
class Selection:
    """The files a run reads, listed once, and where they are: date folder names per kind."""

    files: DataFrame
    folders: dict[str, list[str]]


def _folder(params: CurationParams, name: str) -> str:
    return f"{params.root.rstrip('/')}/{params.layout.folder.format(name)}"


def select_files(spark: SparkSession, params: CurationParams) -> Selection:
    """Choose date folders and files. No valid folder in the chosen range is an error."""
    names = discovery.chosen_folder_names(spark, params.root, params.choice, params.layout)
    listed = discovery.list_files(spark, *[_folder(params, name) for name in names])
    picked = discovery.describe(listed, params.layout, params.root)
    files = discovery.latest_files(picked) if params.latest_only else discovery.all_files(picked)
    files = stage(files, "chosen-files")
    # at most one row per calendar day and kind
    places = files.select("kind", "date_folder").distinct().collect()
    kinds = {p["kind"] for p in places}
    return Selection(files, {k: sorted(p["date_folder"] for p in places if p["kind"] == k) for k in kinds})


def curate_kind(
    spark: SparkSession,
    kind_name: str,
    params: CurationParams,
    header_mapping: DataFrame | None = None,
    selection: Selection | None = None,
) -> Curated | None:
    """Conformed rows of one kind over all chosen folders, None where there is no such file."""
    kind = shaping.KINDS[kind_name]
    pattern = text.check_pattern(params.study_pattern)
    if kind.mapped:
        if header_mapping is None:
            raise ValueError(f"{kind_name} files need a header mapping")
        _check_standards(header_mapping, kind)
    selection = selection or select_files(spark, params)
    if kind_name not in selection.folders:
        return None
    files = selection.files.where(F.col("kind") == kind_name)
    paths = [_folder(params, name) for name in selection.folders[kind_name]]
    glob = discovery.kind_glob(kind_name) if params.layout.named_files else None
    records = ragged_csv.read_ragged_csv(spark, paths, files, glob, params.max_header_rows, params.whole_bytes)

    # per file: study, header positions, verdict
    heads = (
        discovery.describe(records.select("path", "header", "error").distinct(), params.layout, params.root)
        .withColumn("study", text.study_from_name(F.col("name"), pattern))
    )
    if kind.mapped:
        maps = shaping.study_maps(header_mapping).withColumnRenamed("study", "_study")
        heads = dimension_join(heads, maps, {"_study": F.col("study")}, "left")
        positions = shaping.header_positions(F.col("header"), kind, F.col("header_map"))
        unknown = F.col("header_map").isNull()
    else:
        positions = shaping.header_positions(F.col("header"), kind)
        unknown = F.lit(False)
    heads = heads.select(
        F.col("path").alias("_path"),
        "name",
        "extract_date",
        "study",
        positions.alias("positions"),
        F.coalesce("error", F.when(F.col("study").isNull(), shaping.NO_STUDY), F.when(unknown, shaping.UNKNOWN_STUDY))
        .alias("file_error"),
    )
    heads = stage(heads, "file-heads")
    if not kind.mapped:
        _check_columns(heads, kind)
    rejected = heads.where(F.col("file_error").isNotNull()).select(
        F.col("_path").alias("path"), "name", F.col("file_error").alias("error")
    )
    good = heads.where(F.col("file_error").isNull()).drop("file_error")
    rows = dimension_join(
        records.where(F.col("record").isNotNull()).select("path", "record"), good, {"_path": F.col("path")}
    )
    return Curated(
        shaping.conform(rows, kind, values.moment(params.run_timestamp)), rejected, shaping.cast_failures(rows, kind)
    )


def _check_standards(header_mapping: DataFrame, kind: shaping.Kind) -> None:
    """Every target column must be a standard header of the mapping (a sheet of some thirty rows)."""
    wanted = F.array(*[F.lit(h) for _, h, _ in kind.fields])
    found = header_mapping.agg(F.array_except(wanted, F.collect_set(shaping.fixed.MAPPING_HEADER)).alias("missing"))
    missing = found.first()["missing"]
    if missing:
        raise ValueError(f"header mapping lacks {missing}")


def _check_columns(heads: DataFrame, kind: shaping.Kind) -> None:
    """A target column that no readable file has is an error; one that some files lack is null there."""
    usable = heads.where(F.col("file_error").isNull())
    seen = usable.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.get("positions", F.lit(i))).alias(c) for i, (c, _, _) in enumerate(kind.fields)],
    ).first()
    missing = [c for c, _, _ in kind.fields if seen[c] == 0]
    if seen["n"] and missing:
        raise ValueError(f"no {kind.name} file has {missing}")


def run_curation(
    spark: SparkSession,
    params: CurationParams,
    header_mapping: DataFrame,
    target: str,
    whole_kinds: tuple[str, ...] = (),
    database: str | None = None,
) -> dict[str, Curated]:
    """Curate all kinds into ``target/<kind>``.

    Date partitions are replaced one by one; kinds in ``whole_kinds`` replace their table. A kind
    without files, or with none that can be read, is not written. With ``database`` the kinds are catalog tables there, with
    their files below ``target``, and readers see each replacement whole or not at all.
    """
    done = {}
    selection = select_files(spark, params)
    for kind in shaping.KINDS:
        curated = curate_kind(spark, kind, params, header_mapping, selection)
        if curated is None:
            continue
        done[kind] = curated
        if database and kind not in whole_kinds:
            catalog.replace_partitions(curated.rows, f"{database}.{kind}", f"{target}/{kind}")
        elif kind not in whole_kinds:
            sinks.write_partitions(curated.rows, f"{target}/{kind}")
        elif not curated.rows.isEmpty() and database:
            catalog.replace_table(curated.rows, f"{database}.{kind}", f"{target}/{kind}")
        elif not curated.rows.isEmpty():
            sinks.write_whole(curated.rows, f"{target}/{kind}")
    return done


def load_treatment_mapping(raw: DataFrame) -> DataFrame:
    """Treatment mapping sheet as the typed mapping table.

    Headers are compared without line breaks; the TPC header carries explanations on further lines.
    """
    fields = shaping.fixed.headers(shaping.fixed.TREATMENT_MAPPING_HEADERS)
    by_first_line = {c.split("\n")[0].strip(): c for c in raw.columns}
    raw = raw.withColumnsRenamed({by_first_line[h]: c for c, h, _ in fields if h in by_first_line})
    cleaned = raw.select(*[text.without_na(f"`{c}`").alias(c) for c in raw.columns])
    return shaping.cast_to_schema(cleaned, {c: kind for c, _, kind in fields})


def load_header_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Wide header mapping from CSV or Parquet."""
    if path.rstrip("/").endswith(".csv"):
        mapping = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    else:
        mapping = spark.read.parquet(path)
    shaping.study_headers(mapping)
    return mapping


def study_column_first(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Study protocol of the file name in column ``name`` as first column; null where there is none."""
    study = text.study_from_name(F.col(name), text.check_pattern(pattern))
    return df.select(study.alias(STUDY_HEADER), *df.columns)
