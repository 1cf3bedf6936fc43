"""CSV text as column expressions: header lines, open quotes, cells.

A quote counts only where a field starts, as CSV readers have it; inside a quoted field ``""`` stands
for one quote. The patterns are possessive: they never back-track and never recurse on long fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dosecast.functions.text import strip

_QUOTED = r'"(?:[^"]++|"")*+"'
_FIELD = rf'(?:{_QUOTED}[^,]*+|[^",][^,]*+|)'
_ENDS_OPEN = rf'^(?:{_FIELD},)*+"(?:[^"]++|"")*+\z'
_TOKEN = rf',(?:{_QUOTED}[^,]*+|[^,]*+)'
_QUOTED_TOKEN = r'^,"((?:[^"]++|"")*+)"([^,]*+)\z'


def has_quote(line: Column) -> Column:
    return F.contains(line, F.lit('"'))


def ends_open(line: Column) -> Column:
    """Does a line that starts outside quotes end inside them?"""
    return has_quote(line) & F.rlike(line, F.lit(_ENDS_OPEN))


def stays_open(line: Column) -> Column:
    """Does a line that starts inside quotes end inside them?"""
    return F.rlike(F.concat(F.lit('"'), line), F.lit(_ENDS_OPEN))


def is_header(line: Column) -> Column:
    """At least two comma-separated cells, none of them blank. Quotes are not looked at."""
    cells = F.split(line, ",")
    return (F.size(cells) > 1) & F.forall(cells, lambda cell: F.length(strip(cell)) > 0)


def n_cells(record: Column) -> Column:
    """Number of cells of a record."""
    outside = F.when(has_quote(record), F.regexp_replace(record, f"(^|,){_QUOTED}", "$1")).otherwise(record)
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1


def cells(record: Column) -> Column:
    """Cells of a record as array<string>, quotes resolved."""

    def value(token: Column) -> Column:
        quoted = F.regexp_extract(token, _QUOTED_TOKEN, 1)
        rest = F.regexp_extract(token, _QUOTED_TOKEN, 2)
        resolved = F.concat(F.replace(quoted, F.lit('""'), F.lit('"')), rest)
        return F.when(F.startswith(token, F.lit(',"')), resolved).otherwise(F.substr(token, F.lit(2)))

    # the leading comma gives every token, an empty one too, at least one character
    tokens = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_TOKEN), F.lit(0))
    return F.when(has_quote(record), F.transform(tokens, value)).otherwise(F.split(record, ","))
