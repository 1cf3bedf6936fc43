"""Input preparation: known columns, dates, active subjects, normalised text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.fixed_values import (
    EXCLUDED_STATUSES,
    LOOSE_DATE_FORMATS,
    MAPPING_COLUMNS,
    NORMALIZED_MAPPING_COLUMNS,
    NORMALIZED_SUBJECT_COLUMNS,
    SUBJECT_COLUMNS,
)
from dosecast.functions import text, values


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def known_columns(df: DataFrame, known: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The known columns that exist, in the known order, then ``keep``."""
    present = [c for c in known if c in df.columns]
    return df.select(*present, *[c for c in keep if c in df.columns and c not in present])


def coerce_dates(df: DataFrame, formats: Sequence[str] = LOOSE_DATE_FORMATS) -> DataFrame:
    """Every column whose name contains ``date`` as a date; what is no date becomes null."""
    return df.select(
        *[
            values.parse_date_loose(F.col(name), kind, formats).alias(name) if "date" in name.lower() else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def prepare_subjects(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return coerce_dates(known_columns(trim_column_names(df), SUBJECT_COLUMNS, keep))


def prepare_mapping(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Known mapping columns; the first column with TPC in its name counts as ``tpc``."""
    df = trim_column_names(df)
    if "tpc" not in df.columns:
        variant = next((c for c in df.columns if "TPC" in c.upper()), None)
        if variant:
            df = df.withColumnRenamed(variant, "tpc")
    return known_columns(df, MAPPING_COLUMNS, keep)


def active_subjects(df: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES) -> DataFrame:
    """Rows whose status is not excluded (exact text); a null status stays."""
    return df.where(F.coalesce(~F.col("subject_status").isin(*excluded), F.lit(True)))


def _cleaned(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.clean_text(F.col(c).cast("string")) for c in columns if c in df.columns})


def normalize_subjects(df: DataFrame) -> DataFrame:
    return _cleaned(df, NORMALIZED_SUBJECT_COLUMNS)


def normalize_mapping(df: DataFrame) -> DataFrame:
    return _cleaned(df, NORMALIZED_MAPPING_COLUMNS)
