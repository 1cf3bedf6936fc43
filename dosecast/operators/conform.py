"""Records of extracts to typed tables: header mapping, positions, metadata, schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast import fixed_values as fixed
from dosecast.functions import csv_text, text, values


@dataclass(frozen=True)
class Kind:
    """Target table of a file kind. ``mapped``: headers differ per study and go through the header mapping."""

    name: str
    block: str
    mapped: bool = False

    @property
    def fields(self) -> list[tuple[str, str, str]]:
        """(column, header, type) of the columns that come from the file."""
        return fixed.headers(self.block)

    @property
    def columns(self) -> list[str]:
        return ["study_protocol", *[c for c, _, _ in self.fields], *METADATA]


METADATA = {"extract_date": "date", "source_file": "string", "processed_timestamp": "timestamp"}
KINDS = {
    k.name: k
    for k in (
        Kind("subject", fixed.SUBJECT_HEADERS, mapped=True),
        Kind("depot", fixed.DEPOT_HEADERS),
        Kind("site", fixed.SITE_HEADERS),
        Kind("site_supply", fixed.SITE_SUPPLY_HEADERS),
        Kind("country_supply", fixed.COUNTRY_SUPPLY_HEADERS),
    )
}

NO_STUDY = "no study protocol in file name"
UNKNOWN_STUDY = "study not in header mapping"


def study_headers(mapping: DataFrame) -> DataFrame:
    """Wide header mapping to (study, source, standard); blank sources go, both names lose outer space."""
    if fixed.MAPPING_HEADER not in mapping.columns:
        raise ValueError(f"header mapping has no column {fixed.MAPPING_HEADER!r}, only {mapping.columns}")
    studies = [c for c in mapping.columns if c != fixed.MAPPING_HEADER]
    long = mapping.unpivot([fixed.MAPPING_HEADER], studies, "study", "source")
    return (
        long.select("study", text.strip(F.col("source")).alias("source"), F.col(fixed.MAPPING_HEADER).alias("standard"))
        .where(F.col("source") != "")
    )


def study_maps(mapping: DataFrame) -> DataFrame:
    """One row per study of the mapping: source header to standard header. A row per header at most."""
    studies = mapping.select(
        F.explode(F.array(*[F.lit(c) for c in mapping.columns if c != fixed.MAPPING_HEADER])).alias("study")
    ).distinct()
    once = study_headers(mapping).groupBy("study", "source").agg(F.max("standard").alias("standard"))
    entries = once.groupBy("study").agg(F.collect_list(F.struct("source", "standard")).alias("entries"))
    joined = studies.join(entries, "study", "left")
    nothing = F.array().cast("array<struct<source:string,standard:string>>")
    return joined.select("study", F.map_from_entries(F.coalesce("entries", nothing)).alias("header_map"))


def header_positions(header: Column, kind: Kind, header_map: Column | None = None) -> Column:
    """0-based cell position of every target column in a file, null where the file lacks it."""
    if header_map is not None:
        header = F.transform(header, lambda h: F.coalesce(F.element_at(header_map, text.strip(h)), h))
    wanted = F.lit([h for _, h, _ in kind.fields])
    return F.transform(wanted, lambda h: F.nullif(F.array_position(header, h), F.lit(0)).cast("int") - 1)


def _cell_pairs(kind: Kind) -> list[tuple[str, Column, Column]]:
    """(column, text, value) of every file column, from ``_cells`` and ``positions``.

    Positions are found once per file; a row only looks its cells up. Text that stands for missing is null.
    """
    pairs = []
    for i, (column, _, data_type) in enumerate(kind.fields):
        cell = text.without_na(f"get(_cells, get(positions, {i}))")
        pairs.append((column, cell, values.typed(cell, data_type)))
    return pairs


def conform(records: DataFrame, kind: Kind, run_timestamp: Column) -> DataFrame:
    """Rows of the target table out of study, record, positions, extract_date and name."""
    split = records.withColumn("_cells", csv_text.cells(F.col("record")))
    return split.select(
        F.col("study").alias("study_protocol"),
        *[value.alias(column) for column, _, value in _cell_pairs(kind)],
        "extract_date",
        F.col("name").alias("source_file"),
        run_timestamp.cast("timestamp").alias("processed_timestamp"),
    )


def cast_failures(records: DataFrame, kind: Kind) -> DataFrame:
    """(column, n_rows): cells that hold text and do not convert to the type of their column."""
    split = records.withColumn("_cells", csv_text.cells(F.col("record")))
    checked = [(c, cell, value) for c, cell, value in _cell_pairs(kind) if dict(_types(kind))[c] != "string"]
    if not checked:
        return split.sparkSession.createDataFrame([], "column string, n_rows bigint")
    one = split.agg(*[F.count_if(cell.isNotNull() & value.isNull()).alias(c) for c, cell, value in checked])
    return one.unpivot([], [c for c, _, _ in checked], "column", "n_rows")


def _types(kind: Kind) -> list[tuple[str, str]]:
    return [(column, data_type) for column, _, data_type in kind.fields]


def drop_sparse_rows(df: DataFrame, n: int = 1) -> DataFrame:
    """Rows with more than ``n`` non-null values."""
    return df.dropna(thresh=n + 1)


def convert_dates(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = fixed.DATE_FORMATS) -> DataFrame:
    """Text columns to dates, each cell by the first format that fits; absent columns are passed over."""
    return df.withColumns({c: values.parse_date(F.col(c), formats) for c in columns if c in df.columns})


def rename_headers(df: DataFrame, block: str) -> DataFrame:
    """Title-case headers to table columns; other columns keep their names."""
    names = {header: column for column, header, _ in fixed.headers(block)}
    names[fixed.STUDY_HEADER] = "study_protocol"
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def cast_to_schema(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Exactly the schema columns, in order and type; a value that does not convert becomes null."""
    missing = [c for c in schema if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    kinds = dict(df.dtypes)
    out = []
    for name, data_type in schema.items():
        value = F.col(name)
        if kinds[name] == "string" and data_type != "string":
            value = values.typed(value, data_type, ("yyyy-MM-dd",))
        else:
            value = value.try_cast(data_type)
        out.append(value.alias(name))
    return df.select(*out)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; a column some frame lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
