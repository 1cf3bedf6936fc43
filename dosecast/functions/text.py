"""Text expressions: clean-up, drug base names, visit text, file names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from dosecast.fixed_values import CYCLE_PATTERN, DAY_PATTERN, DOSE_PREFIX_PATTERN, FILE_KINDS, NA_TOKENS

# Unicode white space, so that trimming agrees with str.strip()
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
CURLY_QUOTES = "\u2018\u2019\u201c\u201d"
STRAIGHT_QUOTES = "''\"\""


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def clean_text(text: Column) -> Column:
    """Curly quotes to straight ones, outer white space off; case kept, null stays null."""
    return strip(F.translate(text, CURLY_QUOTES, STRAIGHT_QUOTES))


def _number_after(text: Column, pattern: str, default: int) -> Column:
    # (?U): Unicode-aware \s and \d
    digits = F.coalesce(F.regexp_extract(text, "(?iU)" + pattern, 1), F.lit(""))
    return F.when(digits == "", F.lit(default).cast("bigint")).otherwise(digits.try_cast("bigint"))


def cycle_number(visit: Column) -> Column:
    """First cycle number in a visit text, 0 without one, null for one beyond bigint."""
    return _number_after(visit, CYCLE_PATTERN, 0)


def day_number(visit: Column) -> Column:
    """First day number in a visit text, 1 without one, null for one beyond bigint."""
    return _number_after(visit, DAY_PATTERN, 1)


def mentions(visit: Column, word: str) -> Column:
    return F.coalesce(F.contains(F.lower(visit), F.lit(word.lower())), F.lit(False))


def visit_prefix(visit: Column) -> Column:
    """Label prefix of projected visits; crossover outranks TPC."""
    return (
        F.when(mentions(visit, "crossover"), "Crossover ").when(mentions(visit, "tpc"), "TPC ").otherwise("")
    )


def visit_days(text: Column) -> Column:
    """Comma-separated day numbers as array<bigint>; duplicates kept, null gives [].

    Other tokens are dropped. A number beyond bigint counts as the largest one: no visit falls on either.
    """
    largest = F.lit(2**63 - 1)
    numbers = F.transform(
        F.split(text, ","),
        lambda token: F.when(
            F.rlike(strip(token), F.lit(r"^\d+$")), F.coalesce(strip(token).try_cast("bigint"), largest)
        ),
    )
    return F.coalesce(F.array_compact(numbers), F.array().cast("array<bigint>"))


def drug_base_of_match(drug: Column) -> Column:
    """Text before the first white space followed by a digit, else null."""
    found = F.rlike(drug, F.lit("(?U)" + DOSE_PREFIX_PATTERN))
    return F.when(found, F.regexp_extract(drug, "(?U)" + DOSE_PREFIX_PATTERN, 1))


def without_dose(drug: Column) -> Column:
    return strip(F.regexp_replace(drug, r"(?U)\d.*", ""))


def country_steps(name: Column, countries: Column) -> Column:
    """The name, then what is left of it after each of an array of lower-case country names, longest first."""

    def without(name: Column, country: Column) -> Column:
        word = F.concat(F.lit(r"\b\Q"), country, F.lit(r"\E\b"))
        name = F.regexp_replace(name, F.concat(F.lit("(?iU)"), word, F.lit("-?")), F.lit(""))
        return F.regexp_replace(name, F.concat(F.lit("(?iU)-"), word), F.lit(""))

    longest_first = F.array_sort(
        countries,
        lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
        .when(a < b, -1)
        .when(a > b, 1)
        .otherwise(0),
    )
    return F.aggregate(
        longest_first, F.array(name), lambda steps, c: F.concat(steps, F.array(without(F.element_at(steps, -1), c)))
    )


def tidy_base(name: Column) -> Column:
    """A drug name without brackets, outer hyphens and double blanks."""
    name = F.regexp_replace(name, r"[()]", "")
    name = F.regexp_replace(name, r"(?U)^[\s\-]+|[\s\-]+$", "")
    return strip(F.regexp_replace(name, r"(?U)\s{2,}", " "))


def drug_base_of_mapping(drug: Column, countries: Column) -> Column:
    """Drug name without dose, country and brackets; ``countries`` are lower-case names. ``operators.bases`` looks them up."""
    return tidy_base(F.element_at(country_steps(without_dose(drug), countries), -1))


def words_and_gaps(name: Column) -> Column:
    """A text cut at all its word borders, from its first word to its last."""
    inner = F.regexp_replace(name, r"(?U)^\W+|\W+$", "")
    return F.filter(F.split(inner, r"(?U)\b"), lambda part: part != "")


def phrases(parts: Column, longest: Column) -> Column:
    """All runs of at most ``longest`` parts, put together."""
    n = F.size(parts)

    def from_(i: Column) -> Column:
        last = F.least(n - i, longest)
        return F.transform(F.sequence(F.lit(1), last), lambda k: F.array_join(F.slice(parts, i + 1, k), ""))

    runs = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), from_))
    return F.when((n > 0) & (longest > 0), F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def study_from_name(name: Column, pattern: str) -> Column:
    """Study protocol in a file name, null without one."""
    return F.nullif(F.regexp_extract(name, f"({pattern})", 1), F.lit(""))


def file_kind(lower_name: Column) -> Column:
    """Kind of a CSV extract by its lower-case name, null for files to ignore."""
    kind = F.lit(None).cast("string")
    for label, words in reversed(FILE_KINDS.items()):
        fits = F.endswith(lower_name, F.lit(".csv"))
        for word in words:
            fits = fits & F.contains(lower_name, F.lit(word))
        kind = F.when(fits, label).otherwise(kind)
    return kind


_NA_LIST = ", ".join(f"'{token}'" for token in NA_TOKENS)


def without_na(cell: str) -> Column:
    """SQL expression of a text cell as a column, null where the text stands for a missing value."""
    return F.expr(f"CASE WHEN {cell} NOT IN ({_NA_LIST}) THEN {cell} END")


def check_pattern(pattern: str) -> str:
    """A study pattern must compile and must not match the empty string."""
    if re.compile(pattern).match(""):
        raise ValueError(f"study pattern {pattern!r} matches an empty name")
    return pattern
