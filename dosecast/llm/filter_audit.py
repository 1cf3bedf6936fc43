"""Operator 13: how five filters interact, over every order in which they may be applied.

A document's outcome at each step of each order depends on nothing but the set of filters it fails (its mask) and its
labels. So each mask is mapped to one big integer whose 64-bit fields hold what such a document adds to every
count of all 600 steps. The integers are summed per part, each times the number of its documents, and the sum is
unpacked into rows. A field holds at most the number of documents, so none spills into the next below 2**64.

The documents are first reduced to (part, mask, labels), at most 128 rows for a part, so the big integers are
summed over few rows wherever a part is hot. Equal texts are found by their SHA-256: the smallest id per digest is
joined back by digest and id together, so a text with a third of all rows is spread over its ids.

Null texts are empty, a null source is the empty part. A null id is neither smaller nor greater than another, so its
row fails no equality filter and makes none fail, and has no labels. Rows that share id and text are all
first ones. Several label rows of an id count as one that has each mark that any of them has. An
empty table gives no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import prepare
from dosecast.sources.staging import stage

LETTERS = "ABCDE"
# fixed values of the contract
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
SYMBOLS = b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BYTES = 8
GOOD, TOXIC = 1 << len(LETTERS), 2 << len(LETTERS)


def text_fails(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    raw = text.encode("utf-8", "surrogatepass")
    own = raw.split()  # of bytes: at the six ASCII white-space characters alone
    upper = len(raw) - len(raw.translate(None, UPPER))
    failed = (
        len(own) < MIN_WORDS,
        100 * len(set(own)) < MIN_DISTINCT_PERCENT * len(own),
        100 * upper > MAX_UPPER_PERCENT * len(text),
        len(raw) != len(raw.translate(None, SYMBOLS)),
    )
    return sum(1 << i for i, fails in enumerate(failed) if fails)


def text_facts(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and the bits of A to D per document row."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fails, digests = [], []
            for value in batch.column("text"):
                text = value.as_py()
                fails.append(text_fails(text))
                digests.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest())
            columns = {"doc_id": batch.column("doc_id"), "part": batch.column("part")}
            yield pa.record_batch(columns | {"digest": pa.array(digests, pa.binary()), "fails": pa.array(fails, pa.int32())})

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, part string, digest binary, fails int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (filters failed and labels as bits) and the number n of its documents."""
    facts = stage(text_facts(docs), "filter-facts")
    firsts = (
        facts.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first_id"))
        .select(F.col("digest").alias("first_digest"), "first_id")
    )
    rows = facts.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
    same = (F.col("digest") == F.col("first_digest")) & (F.col("doc_id") == F.col("first_id"))
    again = F.col("doc_id").isNotNull() & F.col("first_id").isNull()
    mask = F.col("fails") + F.when(again, 1 << LETTERS.index("E")).otherwise(0)
    rows = rows.join(firsts, same, "left").groupBy("doc_id", "part", mask.alias("mask")).agg(F.sum("n").alias("n"))
    marks = (
        labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("marked"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    bits = F.col("mask") + F.coalesce(F.col("good"), F.lit(0)) * GOOD + F.coalesce(F.col("toxic"), F.lit(0)) * TOXIC
    joined = rows.join(marks, F.col("doc_id") == F.col("marked"), "left")
    return joined.groupBy("part", bits.alias("mask")).agg(F.sum("n").alias("n"))


@cache
def orders() -> list[str]:
    return ["".join(p) for p in permutations(LETTERS)]


def _steps(mask: int) -> Iterator[tuple[int, ...]]:
    """What one document adds to the counts of each step of each order."""
    failed = {letter for i, letter in enumerate(LETTERS) if mask >> i & 1}
    good, toxic = bool(mask & GOOD), bool(mask & TOXIC)
    for order in orders():
        gone = False
        for letter in order:
            fails = letter in failed
            removed = fails and not gone
            redundant = fails and gone
            gone = gone or fails
            yield not gone, removed, redundant, failed == {letter}, removed and good, removed and toxic


@cache
def packed(mask: int) -> int:
    """All outcomes of a mask as one integer."""
    fields = np.array([x for step in _steps(mask) for x in step], dtype="<u8")
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """One row per step, one column per count."""
    size = len(orders()) * len(LETTERS) * len(COUNTS)
    if total >> 8 * FIELD_BYTES * size:
        raise OverflowError("the last field of the sum overflows")
    return np.frombuffer(total.to_bytes(FIELD_BYTES * size, "little"), "<u8").reshape(-1, len(COUNTS)).astype(np.int64)


def part_rows(part: str, masks: list[int], numbers: list[int]) -> pa.Table:
    """All steps of a part from the number of documents of each of its masks."""
    counts = unpacked(sum(n * packed(m) for m, n in zip(masks, numbers, strict=True)))
    steps = [letter for order in orders() for letter in order]
    removed = counts[:, COUNTS.index("removed")]
    own = {letter: int(removed[[s == letter for s in steps]].sum()) for letter in LETTERS}
    columns = {
        "part": pa.array([part] * len(steps)),
        "filter_order": pa.array([order for order in orders() for _ in LETTERS]),
        "step": pa.array([*range(1, len(LETTERS) + 1)] * len(orders()), pa.int32()),
    }
    columns |= {name: pa.array(counts[:, i], pa.int64()) for i, name in enumerate(COUNTS)}
    return pa.table(columns | {"shapley": pa.array([own[s] for s in steps], pa.int64())})


def audit(counts: DataFrame) -> DataFrame:
    """Every step of every order for each part of a table of part, mask and n."""

    def run(key, group):
        return part_rows(key[0].as_py(), group.column("mask").to_pylist(), group.column("n").to_pylist())

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in (*COUNTS, "shapley"))
    return counts.groupBy("part").applyInArrow(run, schema)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(mask_counts(docs, labels))
