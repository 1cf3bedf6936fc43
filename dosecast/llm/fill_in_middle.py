"""Operator 11: fill-in-middle documents by one counted regular expression per row.

``regexp_count`` gives the number n of units (code points) of a text. Two cut points follow from the id alone, and
the row's own pattern ``\\A(.{a}+)(.{b-a}+)(.*+)\\z`` captures prefix, middle and suffix in one match, which
the replacement writes back in the order of the form. The quantifiers are possessive: nothing is ever tried twice.
Restoring is one replacement too: a text that holds a sentinel stays plain, so the first sentinels
are those that were put in, and a sentinel cannot begin inside another.

All of it is one narrow projection of built-in expressions: no shuffle, no state, any row order.

Null and empty texts are plain and empty. A null id counts as an empty one. Repeated rows repeat, an empty table
gives none, and columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import id_text

# fixed values of the contract
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1:"
PLAIN_FROM = 90
SPM_BELOW = 20
#: Units counted in one match, so that counting a long text makes no array of single characters.
UNITS_AT_ONCE = 4096


def unit_count(text: Column) -> Column:
    """Code points of a text: whole runs of units first, then the units of the rest."""
    runs = F.regexp_count(text, F.lit(f"(?s).{{{UNITS_AT_ONCE}}}+"))
    rest = F.substring(text, runs * UNITS_AT_ONCE + 1, F.lit(UNITS_AT_ONCE))
    return runs.cast("bigint") * UNITS_AT_ONCE + F.regexp_count(rest, F.lit("(?s)."))


def hashed(doc_id: Column, group: int) -> Column:
    """The group-th 8-digit group of the sha256 of seed and id, as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")


def rearranged(text: Column, form: Column, prefix: Column, middle: Column) -> Column:
    pattern = F.concat(
        F.lit(r"(?s)\A(.{"), prefix.cast("string"), F.lit(r"}+)(.{"), middle.cast("string"), F.lit(r"}+)(.*+)\z")
    )
    psm = F.lit(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    spm = F.lit(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    parts = F.when(form == "psm", psm).otherwise(spm)
    return F.when(form == "plain", text).otherwise(F.regexp_replace(text, pattern, parts))


def restored(output: Column, form: Column) -> Column:
    """The original text of an output and its form."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every document."""
    rows = id_text(docs, id_col, text_col).withColumn("n", unit_count(F.col("text")))
    for group, name in enumerate(("h1", "h2", "h3", "h4")):
        rows = rows.withColumn(name, hashed(F.col("doc_id"), group))
    first, second = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    taken = F.lit(False)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        taken = taken | F.contains("text", F.lit(sentinel))
    plain = (F.col("n") == 0) | taken | (F.col("h3") % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < SPM_BELOW, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(first, second).alias("a"), F.greatest(first, second).alias("b"))
    cut = F.col("form") != "plain"
    rows = rows.withColumn("prefix_chars", F.when(cut, F.col("a"))).withColumn("middle_chars", F.when(cut, F.col("b") - F.col("a")))
    output = rearranged(F.col("text"), F.col("form"), F.col("prefix_chars"), F.col("middle_chars"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", output.alias("output"))


def digests(docs: DataFrame) -> DataFrame:
    """The documents with the hashes of the output and of the text restored from it."""
    made = fill_in_middle(docs)
    text = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"),
    )
