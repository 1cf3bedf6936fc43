"""Operator 4: base rules and a hashed n-gram log-likelihood ratio, as DataFrame expressions.

The base rules fail documents of fewer than ``MIN_WORDS`` words or with more than half of their words in
3-word windows that repeat. The verdict on the others compares two multinomials over hashed word n-grams
(one and two words, ``BUCKETS`` buckets): one of a trusted target, one of the raw corpus. The score of a
document is the mean over its n-grams of log((t + 1) / (e + 1)), with t the count of the n-gram's bucket in the target and e what
its raw count would give there. The document's own n-grams are left out of both counts, or they would pull its score up if it is
trusted and down if not, the more so the smaller the corpus or the target. A document is kept if its score, rounded to
``DIGITS`` digits, is at least ``MIN_SCORE``, or at least the ``QUANTILE`` of those of the trusted documents that pass the base
rules, whichever is lower. The quantile is an exact order statistic, so no partitioning changes a verdict. What the target holds
nothing like (a language without trusted documents) cannot be told from what it shuns.

Each text is cut into words once: one pass writes the base facts and the document's distinct buckets with their counts to the shared
folder, and counting, threshold and verdict work on those.

All counts cover all documents. N-grams are counted into buckets before anything is shuffled, so what moves and
what the scoring reads is one row per bucket and task. The counts are two arrays of ``BUCKETS`` numbers,
a size that does not depend on the data.

Null and empty texts have no words and fail the base rules. Repeated rows are judged alike. Ids play no part
but for the trusted target; null ids are never trusted. With an empty target every document that passes the
base rules is kept. Extra columns pass through ``keep_good``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import fresh
from dosecast.operators.joins import measured_bytes
from dosecast.sources.staging import stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BUCKETS = 1 << 14
MIN_SCORE = -0.045
QUANTILE = 0.01
SMOOTHING = 1.0
DIGITS = 5
# fixed values of the contract
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
BROADCAST_BYTES = 64 << 20
#: Rows of whole texts wait in the writer until a row group is full, so small groups keep the memory of a task small.
ROW_GROUP_BYTES = 16 << 20


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Runs of anything but the six white-space characters; null and blank texts have none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def neighbours(left: Column, right: Column, apart: int) -> Column:
    """Hash of each element of ``left`` with that of ``right`` some places on, as far as there are both."""
    shifted = F.slice(right, F.lit(apart + 1), F.greatest(F.size(right) - apart, F.lit(0)))
    cut = F.slice(left, F.lit(1), F.size(shifted))
    return F.zip_with(cut, shifted, lambda a, b: F.xxhash64(a, b))


def repeated_words(threes: Column) -> Column:
    """Words inside 3-word windows, given by their hashes, that occur at least twice."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            placed,
            lambda p: F.filter(
                p, lambda x, i: F.get(p, i - 1)["h"].eqNullSafe(x["h"]) | F.get(p, i + 1)["h"].eqNullSafe(x["h"])
            ),
        )
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        # each window adds the words beyond the one before it, three at most
        gaps = let(
            starts, lambda s: F.transform(s, lambda x, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), x - F.get(s, i - 1))))
        )
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda n, x: n + x)

    return let(
        threes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)),
    )


def histogram(buckets: Column) -> Column:
    """Distinct buckets in order and how often each occurs."""
    empty = F.array().cast("array<int>")

    def counted(b: Column) -> Column:
        n = F.size(b)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~F.get(b, i).eqNullSafe(F.get(b, i - 1)))

        def runs(s: Column) -> Column:
            ends = F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(n))
            return F.struct(
                F.transform(s, lambda i: F.get(b, i)).alias("buckets"), F.zip_with(s, ends, lambda x, y: y - x).alias("counts")
            )

        return F.when(n > 0, let(starts, runs)).otherwise(F.struct(empty.alias("buckets"), empty.alias("counts")))

    return let(F.sort_array(buckets), counted)


def text_facts(text: Column) -> Column:
    """All that the rules need of a text, the words cut out once."""
    filled = F.coalesce(text, F.lit(""))
    lines = let(
        F.filter(F.split(filled, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != ""),
        lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
    )

    def of_words(w: Column) -> Column:
        def of_hashes(ones: Column) -> Column:
            def of_pairs(twos: Column) -> Column:
                grams = F.transform(F.concat(ones, twos), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
                return F.struct(
                    F.size(ones).cast("bigint").alias("n_words"),
                    F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                    F.length(F.regexp_replace(filled, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
                    lines.alias("n_dup_lines"),
                    repeated_words(neighbours(twos, ones, 2)).alias("n_repeat_words"),
                    histogram(grams).alias("grams"),
                )

            return let(neighbours(w, w, 1), of_pairs)

        return let(F.transform(w, lambda x: F.xxhash64(x)), of_hashes)

    return let(words(text), of_words)


def flagged(docs: DataFrame, trusted: DataFrame, id_col: str, name: str, how: str = "left") -> DataFrame:
    """The documents with a column ``name``: 1 if the id is trusted, else 0. Repeated trusted ids count once."""
    own = fresh(docs, "trusted_id")
    ids = trusted.select(F.col(trusted.columns[0]).alias(own)).where(F.col(own).isNotNull()).distinct()
    side = F.broadcast(ids) if measured_bytes(ids) <= BROADCAST_BYTES else ids.hint("merge")
    joined = docs.join(side, F.col(id_col) == F.col(own), how)
    return joined.withColumn(name, F.col(own).isNotNull().cast("int")).drop(own)


def bucket_counts(facts: DataFrame, name: str, flag: str) -> DataFrame:
    """bucket, raw and target counts over all documents of the facts table."""
    grams = F.col(name)["grams"]
    one = facts.select(F.explode(F.arrays_zip(grams["buckets"].alias("b"), grams["counts"].alias("n"))).alias("g"), F.col(flag).alias("t"))
    return one.groupBy(F.col("g")["b"].alias("bucket")).agg(
        F.sum("g.n").alias("raw"), F.sum(F.col("g")["n"] * F.col("t")).alias("target")
    )


def collected(counts: DataFrame) -> tuple[list[int], list[int]]:
    """Raw and target counts by bucket. ``BUCKETS`` rows reach the driver."""
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for row in counts.collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    return raw, target


def held_out(grams: Column, in_target: Column, raw: list[int], target: list[int]) -> Column:
    """Mean log ratio of the n-grams of a document against what the other documents hold, rounded."""
    raws, targets = constant_array(raw), constant_array(target)

    def of(g: Column) -> Column:
        def total(n: Column) -> Column:
            share = (F.lit(sum(target)) - n * in_target) / F.greatest(F.lit(sum(raw)) - n, F.lit(1))

            def mean(s: Column) -> Column:
                def part(bucket: Column, own: Column) -> Column:
                    here = F.get(targets, bucket) - own * in_target + SMOOTHING
                    there = (F.get(raws, bucket) - own) * s + SMOOTHING
                    return own * F.log(here / there)

                terms = F.zip_with(g["buckets"], g["counts"], part)
                return F.round(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / n, DIGITS)

            return let(share, mean)

        n = F.aggregate(g["counts"], F.lit(0).cast("bigint"), lambda a, x: a + x)
        return F.when(F.size(g["counts"]) > 0, let(n, total)).otherwise(F.lit(0.0))

    return let(grams, of)


def base_failed(facts: Column) -> Column:
    n, repeat = facts["n_words"], facts["n_repeat_words"]
    return (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)


def cut(scores: DataFrame, score: str) -> float:
    """The least score that is kept, from those of the trusted documents that pass the base rules."""
    # scores are rounded, so the exact statistic keeps one count per distinct value
    low = scores.agg(F.expr(f"percentile_disc({QUANTILE}) WITHIN GROUP (ORDER BY `{score}`)").alias("low")).first()["low"]
    return MIN_SCORE if low is None else min(MIN_SCORE, low)


def constant_array(values: list[float]) -> Column:
    """An array that is one constant of the plan, not one expression per element."""
    return F.from_json(F.lit(json.dumps(values)), "array<double>")


def annotate(
    docs: DataFrame, trusted: DataFrame, keep: list[str], text_col: str = "text", id_col: str = "doc_id"
) -> tuple[DataFrame, str]:
    """The columns ``keep`` of the documents with a struct column of all facts and the verdict ``kept``; and its name."""
    name, flag = fresh(docs, "quality_facts"), fresh(docs, "in_target")
    rows = flagged(docs, trusted, id_col, flag).withColumn(name, text_facts(F.col(text_col)))
    rows = stage(rows.select(*keep, flag, name), "quality-facts", **{"parquet.block.size": str(ROW_GROUP_BYTES)})
    raw, target = collected(bucket_counts(rows, name, flag))
    facts = F.col(name)
    failed = base_failed(facts)
    score = F.when(~failed & (F.lit(sum(target)) > 0), held_out(facts["grams"], F.col(flag), raw, target))
    passed = rows.where((F.col(flag) == 1) & ~failed).select(score.alias("score")) if sum(target) else None
    least = MIN_SCORE if passed is None else cut(passed, "score")
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def judged(value: Column) -> Column:
        kept = ~failed & F.coalesce(value >= least, F.lit(not sum(target)))
        return F.struct(
            *[facts[c].alias(c) for c in columns], failed.alias("base_failed"), kept.alias("kept"), value.alias("held_out")
        )

    return rows.withColumn(name, let(score, judged)).drop(flag), name


def rules(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id and all facts per document row."""
    out, name = annotate(docs, trusted, ["doc_id"])
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "held_out")
    return out.select("doc_id", *[F.col(name)[c].alias(c) for c in columns])


def keep_good(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The documents whose verdict is to keep, with their own columns."""
    out, name = annotate(docs, trusted, docs.columns)
    return out.where(F.col(name)["kept"]).drop(name)
