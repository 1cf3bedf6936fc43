"""Operator 6: benchmark decontamination by a broadcast hash set of normalised n-grams.

Texts are lower-cased in A-Z and cut into words. Each benchmark item gives its windows of ``window`` words, or
one window of all its words where it has fewer. Words of the benchmark get numbers; a training text becomes
the numbers of its words, and rolling hashes of its windows are looked up in the sorted hashes of the
benchmark with numpy. Every hit is verified word by word, so a hash collision changes nothing.

The benchmark's words and windows are broadcast while their measured size is within ``broadcast_bytes``.
Beyond that nothing of it reaches the driver: hashes of the documents' windows meet those of the benchmark in a shuffle, and
the words at the places that meet are compared with the benchmark's in a second one. Rows are told apart by a
row number, never by their id, so results do not depend on the size.

Null texts and items without words have no windows. An item id that is null is left out of the list of items, its
windows still count as hits. Repeated items and documents give repeated results for each. Extra columns
pass through ``decontaminate`` untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import fresh, id_text, id_type, prepare
from dosecast.sources.staging import stage

WINDOW = 10
BROADCAST_BYTES = 64 << 20
# word bytes are 0-9, a-z once A-Z are lower-cased, and all of characters beyond ASCII
_WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20
    for b in (*range(0x80), *range(0x80, 0x100))
)
_RUN = re.compile(rb"[^ ]+")
_BASE = 0x9E3779B97F4A7C15


def _spaced(text: str | None) -> bytes:
    """The text in UTF-8, of the same length, with words lower-cased and all else blank."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)


def words(text: str | None) -> list[bytes]:
    return _spaced(text).split()


class Windows:
    """Benchmark windows: word numbers, sorted hashes by length, and what verifies a hit."""

    def __init__(self, rows: list[tuple[object, list[str]]]):
        self.number: dict[bytes, int] = {}
        self.items: dict[int, dict[tuple[int, ...], list]] = {}
        for item, grams in rows:
            key = tuple(self.number.setdefault(w, len(self.number) + 1) for w in map(str.encode, grams))
            self.items.setdefault(len(key), {}).setdefault(key, []).append(item)
        self.hashes = {}
        for length, known in self.items.items():
            keys = np.array(list(known), dtype=np.uint64).reshape(-1, length)
            self.hashes[length] = np.unique(_rolled(keys.ravel(), length)[::length])

    def find(self, numbers: np.ndarray) -> tuple[list[tuple[int, int]], dict]:
        """Verified (position, length) of every occurrence, and the items that occur."""
        found, items = [], {}
        for length, sorted_hashes in self.hashes.items():
            if len(numbers) < length:
                continue
            rolled = _rolled(numbers, length)
            at = np.minimum(np.searchsorted(sorted_hashes, rolled), len(sorted_hashes) - 1)
            for start in np.flatnonzero(sorted_hashes[at] == rolled).tolist():
                key = tuple(numbers[start : start + length].tolist())
                own = self.items[length].get(key)
                if own:
                    found.append((start, length))
                    items.update(dict.fromkeys(own))
        return found, items


def _rolled(numbers: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` numbers, by position; arithmetic is modulo 2**64."""
    count = len(numbers) - length + 1
    out = np.zeros(count, dtype=np.uint64)
    numbers = numbers.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(length):
        out = out * np.uint64(_BASE) + numbers[k : k + count]
    return out


def item_windows(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id") -> DataFrame:
    """item_id and its distinct windows as arrays of words, made on the executors."""
    prepare(benchmark.sparkSession)
    kind = id_type(benchmark, item_col)

    def run(batches):
        for batch in batches:
            ids, grams = [], []
            for item, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = words(text)
                spans = [own[i : i + window] for i in range(max(1, len(own) - window + 1))] if own else []
                for gram in dict.fromkeys(map(tuple, spans)):
                    ids.append(item)
                    grams.append([w.decode("utf-8", "replace") for w in gram])
            yield pa.record_batch(
                {
                    "item_id": pa.array(ids, batch.schema.field("doc_id").type),
                    "gram": pa.array(grams, pa.list_(pa.string())),
                }
            )

    return id_text(benchmark, item_col).mapInArrow(run, f"item_id {kind}, gram array<string>")


def _gram_bytes(grams: DataFrame) -> int:
    size = F.sum(F.octet_length(F.array_join("gram", " ")) + 64)
    return grams.agg(F.coalesce(size, F.lit(0)).alias("bytes")).first()["bytes"]


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, spans (word number, end exclusive; merged) and items per document row."""
    prepare(docs.sparkSession)
    grams = item_windows(benchmark, window)
    schema = (
        f"doc_id {id_type(docs)}, n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"
    )
    if _gram_bytes(grams) <= broadcast_bytes:
        return id_text(docs).mapInArrow(_scanner(docs.sparkSession, grams), schema)
    texts = stage(id_text(docs).withColumn("row", F.monotonically_increasing_id()), "scan")
    return _joined_hits(texts, grams).select("doc_id", "n_words", "spans", "items")


def _joined_hits(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """row, doc_id, n_words, spans and items per row of ``texts`` (row, doc_id, text), by shuffles alone."""
    grams = stage(grams, "grams")
    lengths = sorted(r.n for r in grams.select(F.size("gram").alias("n")).distinct().collect())

    def hashed(batches):
        for batch in batches:
            joined = [" ".join(g) for g in batch.column("gram").to_pylist()]
            pairs = [(len(g), _window_hashes(g, len(g))[0]) for g in map(str.split, joined)]
            yield pa.record_batch(
                {
                    "length": pa.array([n for n, _ in pairs], pa.int32()),
                    "hash": pa.array(np.array([h for _, h in pairs], np.uint64).view(np.int64)),
                }
            )

    def windows(batches):
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = words(text)
                for length in lengths:
                    if len(own) >= length:
                        hashes = _window_hashes(own, length).view(np.int64)
                        n = len(hashes)
                        yield pa.record_batch(
                            {
                                "row": pa.array(np.full(n, row, np.int64)),
                                "start": pa.array(np.arange(n, dtype=np.int64)),
                                "length": pa.array(np.full(n, length, np.int32)),
                                "hash": pa.array(hashes),
                            }
                        )

    def spelled(batches):
        for batch in batches:
            rows, starts, ends, said = [], [], [], []
            for row, text, at in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "at")), strict=True):
                own = words(text)
                for x in at:
                    start, end = x["start"], x["start"] + x["length"]
                    rows.append(row)
                    starts.append(start)
                    ends.append(end)
                    said.append(b" ".join(own[start:end]).decode("utf-8", "replace"))
            yield pa.record_batch(
                {
                    "row": pa.array(rows, pa.int64()), "start": pa.array(starts, pa.int64()),
                    "end": pa.array(ends, pa.int64()), "said": pa.array(said, pa.string()),
                }
            )

    def counted(batches):
        for batch in batches:
            n = [len(words(text)) for text in batch.column("text").to_pylist()]
            yield pa.record_batch({"row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_words": pa.array(n, pa.int64())})

    known = grams.select("gram").mapInArrow(hashed, "length int, hash bigint").distinct()
    spots = texts.select("row", "text").mapInArrow(windows, "row bigint, start bigint, length int, hash bigint")
    spots = spots.join(known.hint("merge"), ["length", "hash"], "left_semi")
    places = spots.groupBy("row").agg(F.collect_list(F.struct("start", "length")).alias("at"))
    met = texts.select("row", "text").join(places.hint("merge"), "row")
    met = met.mapInArrow(spelled, "row bigint, start bigint, end bigint, said string")
    # a window once for all items that have it, so that its places are not repeated by item
    items = F.array_compact(F.collect_set(F.col("item_id").cast("string")))
    owners = grams.groupBy(F.array_join("gram", " ").alias("said")).agg(items.alias("own"))
    found = met.join(owners.hint("merge"), "said").groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("items"),
    )
    rows = texts.mapInArrow(counted, f"row bigint, doc_id {id_type(texts)}, n_words bigint")
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return rows.join(found.hint("merge"), "row", "left").select(
        "row", "doc_id", "n_words", F.coalesce(_merged(F.col("hit")), none).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _window_hashes(own: list, length: int) -> np.ndarray:
    """Hash of each window of ``length`` words, the same in every process."""
    code = {w: hashlib.blake2b(w.encode() if isinstance(w, str) else w, digest_size=8).digest() for w in set(own)}
    return _rolled(np.frombuffer(b"".join(code[w] for w in own), np.uint64), length)


def _merged(spans):
    """Overlapping spans of a sorted array joined."""
    def step(done, one):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= one["start"])
        widened = F.struct(last["start"].alias("start"), F.greatest(last["end"], one["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(widened))).otherwise(
            F.concat(done, F.array(one))
        )

    return F.aggregate(spans, F.array().cast("array<struct<start: bigint, end: bigint>>"), step)


def _scanner(spark, grams: DataFrame):
    rows = [(r.item_id, r.gram) for r in grams.toLocalIterator()]
    shared = spark.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Windows(shared.value)
        for batch in batches:
            out = [_scan(known, text) for text in batch.column("text").to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array([n for n, _, _ in out], pa.int64()),
                "spans": pa.array(
                    [[{"start": a, "end": b} for a, b in s] for _, s, _ in out],
                    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                ),
                "items": pa.array([i for _, _, i in out], pa.list_(pa.string())),
            })

    return run


def _scan(known: Windows, text: str) -> tuple[int, list[tuple[int, int]], list[str]]:
    own = words(text)
    number = known.number
    numbers = np.fromiter((number.get(w, 0) for w in own), np.uint64, len(own))
    found, items = known.find(numbers)
    spans: list[tuple[int, int]] = []
    for start, length in sorted(found):
        if spans and spans[-1][1] >= start:
            spans[-1] = spans[-1][0], max(spans[-1][1], start + length)
        else:
            spans.append((start, start + length))
    return len(own), spans, sorted({str(i) for i in items if i is not None})


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document row."""
    found = hits(docs, benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The documents without contaminated ones, or with ``remove="spans"`` all of them without the hit words.

    A removed span goes from its first word to its last, and becomes one blank. Each row is judged by its own text.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove!r}")
    prepare(docs.sparkSession)
    grams = item_windows(benchmark, window)
    if _gram_bytes(grams) > broadcast_bytes:
        row, spans = fresh(docs, "row_number"), fresh(docs, "hit_spans")
        numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "scan")
        found = _joined_hits(id_text(numbered, row).select(F.col("doc_id").alias("row"), "doc_id", "text"), grams)
        bad = found.where(F.size("spans") > 0).select(F.col("row").alias(row), F.col("spans").alias(spans))
        if remove == "documents":
            return numbered.join(bad.hint("merge"), row, "left_anti").select(*docs.columns)

        def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cut = [
                    text if not own else without(text, [(x["start"], x["end"]) for x in own])
                    for text, own in zip(batch.column("text").to_pylist(), batch.column(spans).to_pylist(), strict=True)
                ]
                at = batch.schema.get_field_index("text")
                batch = batch.set_column(at, batch.schema.field(at), pa.array(cut, batch.schema.field(at).type))
                yield batch.select(docs_columns)

        docs_columns = docs.columns
        both = numbered.join(bad.hint("merge"), row, "left").select(*docs.columns, spans)
        return both.mapInArrow(shortened, docs.schema)
    rows = [(r.item_id, r.gram) for r in grams.toLocalIterator()]
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Windows(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = [_scan(known, text)[1] for text in texts]
            if remove == "documents":
                yield batch.filter(pa.array([not s for s in spans], pa.bool_()))
                continue
            at = batch.schema.get_field_index("text")
            cut = [text if not s else without(text, s) for text, s in zip(texts, spans, strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(cut, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with each span of words replaced by one blank."""
    edges = [m.span() for m in _RUN.finditer(_spaced(text))]
    text, out, at = text.encode("utf-8", "surrogatepass"), [], 0
    for start, end in spans:
        out.append(text[at : edges[start][0]])
        at = edges[end - 1][1]
    return b" ".join([*out, text[at:]]).decode("utf-8", "surrogatepass")
