"""Typed values out of text: dates in several formats, whole numbers, schema casts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dosecast.fixed_values import DATE_FORMATS, LOOSE_DATE_FORMATS


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date by the first format that fits the cell, null if none does."""
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in formats])


def parse_date_loose(value: Column, data_type: str, formats: Sequence[str] = LOOSE_DATE_FORMATS) -> Column:
    """Date out of whatever a column holds: ISO text, or text in one of ``formats``; other text becomes null."""
    if data_type == "string":
        text = F.trim(value)
        return F.coalesce(text.try_cast("timestamp").cast("date"), parse_date(text, formats))
    return value.cast("date")


def whole_number(text: Column, data_type: str) -> Column:
    """Integer cast that also takes ``8.0``; null for text that is no number or out of range."""
    return F.coalesce(text.try_cast(data_type), text.try_cast("decimal(38,10)").try_cast(data_type))


def typed(text: Column, data_type: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text cell as a value of a target column."""
    if data_type == "date":
        return parse_date(text, formats)
    if data_type in ("int", "bigint"):
        return whole_number(text, data_type)
    return text if data_type == "string" else text.try_cast(data_type)


def moment(stamp: dt.datetime) -> Column:
    """Timestamp literal that reads the same in the session's time zone, whatever that of the driver."""
    return F.lit(stamp.isoformat(sep=" ")).cast("timestamp")
