"""Operator 1: token counts from distinct pre-tokens.

Texts are read once and written as blocks of documents: the distinct pre-tokens of the block, and for each
document the numbers and frequencies of its own. Each distinct pre-token of the corpus is then counted
once, its count is joined to all blocks that hold it, and every document sums count times frequency. No
token id is ever made, and the rows that move are the distinct pre-tokens of blocks, not those of documents: their
counts come back as one packed list for each block and task, to blocks that lie in buckets by their number.

A block closes at ``BLOCK_CHARS`` characters, so its vocabulary and memory have a bound whatever the
corpus is. A pre-token that occurs everywhere has one row per block; the adaptive skew join splits it.

Null texts are empty; an empty text has no tokens. Every row of the input gives one row; repeated rows
repeat. Null ids are kept. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import WORD_BPE, bucketed, id_text, id_type, loaded, prepare
from dosecast.llm.pretokens import WordBpe

BLOCK_CHARS = 16 << 20
BLOCK_DOCS = 50_000
#: Counts that a task packs at once.
PACK_ROWS = 1 << 20


def token_counts(docs: DataFrame, tokenizer: str = WORD_BPE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens per document."""
    prepare(docs.sparkSession)
    kind = id_type(docs)
    schema = (
        f"block bigint, pieces array<string>, doc_id array<{kind}>, n_bytes array<bigint>, "
        "n_pieces array<int>, piece_numbers binary, frequencies binary"
    )

    def make(batches):
        return frequency_blocks(batches, tokenizer, block_chars)

    blocks = bucketed(id_text(docs).mapInArrow(make, schema), "pretokens", "block")
    pieces = blocks.select("block", F.posexplode("pieces").alias("number", "piece"))
    counted = pieces.select("piece").distinct().mapInArrow(
        lambda batches: piece_counts(batches, tokenizer), "piece string, n int"
    )
    found = pieces.join(counted.hint("merge"), "piece").select("block", "number", "n")
    numbers = found.mapInArrow(count_packs, "block bigint, pack binary").groupBy("block").agg(F.collect_list("pack").alias("packs"))
    sums = blocks.drop("pieces").join(numbers.hint("merge"), "block", "left")
    return sums.mapInArrow(document_sums, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")


def frequency_blocks(batches: Iterator[pa.RecordBatch], tokenizer: str, block_chars: int) -> Iterator[pa.RecordBatch]:
    bpe: WordBpe = loaded(WordBpe, tokenizer)
    block = _Block(bpe)
    made = 0
    for batch in batches:
        block.id_type = batch.schema.field("doc_id").type
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            block.add(doc_id.as_py(), text.as_py())
            if block.chars >= block_chars or len(block.ids) >= BLOCK_DOCS:
                yield block.record(made)
                made, fresh = made + 1, _Block(bpe)
                fresh.id_type, block = block.id_type, fresh
    if block.ids:
        yield block.record(made)


def count_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of block, number and n as one packed list of numbers and counts per block."""
    held: list[pa.RecordBatch] = []

    def packed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        block, number, n = (rows.column(c).to_numpy() for c in ("block", "number", "n"))
        order = np.lexsort((number, block))
        names, first = np.unique(block[order], return_index=True)
        parts = zip(np.split(number[order], first[1:]), np.split(n[order], first[1:]))
        packs = [_binary([np.diff(a, prepend=0), b]) for a, b in parts]
        return pa.record_batch({"block": pa.array(names, pa.int64()), "pack": pa.array(packs, pa.binary())})

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= PACK_ROWS:
            yield packed()
            held = []
    if sum(b.num_rows for b in held):
        yield packed()


def _binary(arrays: list[np.ndarray]) -> bytes:
    """Unsigned 32-bit integers, compressed; equal bytes together pack better."""
    raw = np.concatenate(arrays).astype("<u4") if arrays else np.zeros(0, "<u4")
    columns = raw.view(np.uint8).reshape(-1, 4).T.copy()
    return columns.size.to_bytes(8, "little") + pa.Codec("zstd").compress(columns.tobytes(), asbytes=True)


class _Block:
    def __init__(self, bpe: WordBpe):
        self.bpe, self.chars, self.id_type = bpe, 0, pa.int64()
        self.numbers: dict[str, int] = {}
        self.of_word: dict[str, tuple[int, ...]] = {}
        self.ids, self.n_bytes, self.n_pieces, self.parts, self.times = [], [], [], [], []

    def _word(self, word: str) -> tuple[int, ...]:
        numbers = self.numbers
        found = tuple(numbers.setdefault(p, len(numbers)) for p in self.bpe.pieces(word))
        self.of_word[word] = found
        return found

    def add(self, doc_id, text: str) -> None:
        flat: list[int] = []
        known = self.of_word.get
        for special, part in self.bpe.segments(text):
            if special:
                # a special token is its own pre-token; no pre-token of a text looks like it
                flat.append(self.numbers.setdefault(part, len(self.numbers)))
                continue
            for word in self.bpe.words(part):
                found = known(word)
                flat.extend(self._word(word) if found is None else found)
        numbers, times = np.unique(np.array(flat, dtype=np.uint32), return_counts=True)
        self.ids.append(doc_id)
        self.n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
        self.n_pieces.append(len(numbers))
        self.parts.append(np.diff(numbers, prepend=np.uint32(0)).astype(np.uint32))
        self.times.append(times.astype(np.uint32))
        self.chars += len(text)

    def record(self, made: int) -> pa.RecordBatch:
        task = TaskContext.get()
        number = ((task.partitionId() if task else 0) << 32) + made
        ints = pa.list_(pa.int64())
        return pa.record_batch(
            {
                "block": pa.array([number], pa.int64()),
                "pieces": pa.array([list(self.numbers)], pa.list_(pa.string())),
                "doc_id": pa.array([self.ids], pa.list_(self.id_type)),
                "n_bytes": pa.array([self.n_bytes], ints),
                "n_pieces": pa.array([self.n_pieces], pa.list_(pa.int32())),
                "piece_numbers": pa.array([_binary(self.parts)], pa.binary()),
                "frequencies": pa.array([_binary(self.times)], pa.binary()),
            }
        )


def _unpacked(value: bytes) -> np.ndarray:
    size = int.from_bytes(value[:8], "little")
    if not size:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(pa.Codec("zstd").decompress(value[8:], size, asbytes=True), np.uint8)
    return raw.reshape(4, -1).T.copy().view("<u4").ravel()


def piece_counts(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Number of tokens of each distinct pre-token."""
    bpe: WordBpe = loaded(WordBpe, tokenizer)
    merge = bpe.library.model.tokenize
    for batch in batches:
        pieces = batch.column("piece").to_pylist()
        counts = [1 if p in bpe.special else len(merge(bpe.symbols(p))) for p in pieces]
        yield pa.record_batch({"piece": batch.column("piece"), "n": pa.array(counts, pa.int32())})


def _counts_of(packs: list[bytes]) -> np.ndarray:
    """Counts by number."""
    pairs = [np.split(_unpacked(p).astype(np.int64), 2) for p in packs]
    counts = np.zeros(sum(len(steps) for steps, _ in pairs), np.int64)
    for steps, n in pairs:
        counts[np.cumsum(steps)] = n
    return counts


def document_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = {name: batch.column(name)[row] for name in batch.schema.names}
            counts = _counts_of(one["packs"].as_py() or [])
            lengths = np.array(one["n_pieces"].values, dtype=np.int64)
            steps = _unpacked(one["piece_numbers"].as_py()).astype(np.int64)
            ends = np.cumsum(lengths)
            # numbers were stored as steps within each document
            run = np.cumsum(steps)
            before = np.concatenate([[0], run])[ends - lengths]
            numbers = run - np.repeat(before, lengths)
            tokens = np.concatenate([[0], np.cumsum(counts[numbers] * _unpacked(one["frequencies"].as_py()))])
            yield pa.record_batch(
                {
                    "doc_id": one["doc_id"].values,
                    "n_bytes": one["n_bytes"].values,
                    "n_tokens": pa.array(tokens[ends] - tokens[ends - lengths], pa.int64()),
                }
            )
