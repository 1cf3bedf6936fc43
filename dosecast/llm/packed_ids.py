"""Operator 5: token ids as fixed-width bit packing, with block offsets.

Each id takes the bits of the largest id of the vocabulary, least significant bit first, id after id. A block is
a run of whole documents in ascending id order; its row holds the first document and id number, where each
document starts, and the packed bytes. Any document is unpacked on its own from its bit offset, and a whole
block with numpy at once. The rows are stored as Parquet, so that any store Spark can write will do, and the
minimum and maximum document of a row group leads a reader to its block.

Documents are range-partitioned by id before they are encoded, so the sort moves texts once and the sample
that sets the ranges reads ids alone. A shard is one range; where it starts follows from one total per shard.

Null texts are empty and hold the end id alone. Null ids come first; rows with equal ids follow each other by
text, so equal input gives equal files. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dosecast.llm.common import BYTE_BPE, id_text, id_type, loaded, prepare
from dosecast.sources.staging import fresh_path

BLOCK_IDS = 1 << 18
END_ID = 2
KEPT_PIECES = 1_000_000
KEPT_CHARS = 32 << 20
PARTS_A_CALL = 256
_RUN = re.compile(r" ?\S+|\s+(?!\S)|\s+").findall
_PUNCTUATION = ".,;:!?#*$%&|<>()"
_ONLY_PYTHON_SPACE = re.compile("[\x1c-\x1f]")  # white space to Python alone


def bits_for(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary of that size."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other in ``bits`` bits each, least significant bit first."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if bits == 16:
        return ids.astype("<u2").tobytes()
    out = []
    for at in range(0, len(ids), 1 << 20):  # a multiple of 8 ids fills whole bytes
        each = np.unpackbits(ids[at : at + (1 << 20)].view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        out.append(np.packbits(each[:, :bits].ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from id number ``first`` on; only their bytes are touched."""
    if bits == 16:
        return np.frombuffer(data, "<u2", count, first * 2).astype("<u4")
    low, high = first * bits, (first + count) * bits
    raw = np.frombuffer(data, np.uint8, (high + 7) // 8 - low // 8, low // 8)
    flat = np.unpackbits(raw, bitorder="little")[low % 8 : low % 8 + count * bits].reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def write_packed(
    docs: DataFrame, path: str, tokenizer: str = BYTE_BPE, end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> int:
    """Encode all documents and write their packed ids under ``path``; returns the bits of an id."""
    prepare(docs.sparkSession)
    bits = bits_for(max(loaded(_tokenizer, tokenizer).get_vocab_size(), end_id + 1))
    kind = id_type(docs)
    schema = (
        f"shard int, block int, first_doc {kind}, last_doc {kind}, bits int, first_id bigint, n_ids bigint, "
        f"doc_id array<{kind}>, doc_start array<bigint>, packed binary"
    )
    ordered = id_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInArrow(lambda batches: _blocks(batches, tokenizer, end_id, bits, block_ids), schema)
    blocks.write.parquet(path)
    return bits


def _tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library


def _parts(run: str) -> tuple[str, ...]:
    """A run cut where its last letter or number is followed by punctuation, at which the pattern cuts too."""
    core = run.rstrip(_PUNCTUATION)
    return (core, run[len(core) :]) if len(core) < len(run) and core[-1:].isalnum() else (run,)


class _Rows:
    """Id rows one after the other in an array that grows."""

    def __init__(self):
        self.flat, self.starts, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        base, rows = int(self.starts[self.n]), len(lengths)
        self.flat = _room(self.flat, base + len(ids))
        self.starts = _room(self.starts, self.n + rows + 1)
        self.flat[base : base + len(ids)] = ids
        self.starts[self.n + 1 : self.n + rows + 1] = base + np.cumsum(lengths)
        self.n += rows

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows ``at``, joined, and the length of each."""
        first = self.starts[at]
        count = self.starts[at + 1] - first
        ends = np.cumsum(count)
        places = np.repeat(first - ends + count, count)
        places += np.arange(len(places))
        return self.flat[places], count


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    return np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])


class Encoder:
    """Ids of whole texts, as the library gives them.

    A byte-level pattern with the blank at the front of a word begins a new piece at every blank that follows a non-blank.
    So a text is cut at its blanks, and the ids of each distinct piece are made once and kept. A piece in turn
    is cut into runs of non-blanks and of white space, whose ids are asked of the library, many in one call with line
    feeds between them. Where white space comes before a blank, where a text holds a special token, and for tokenizers
    with other rules, the text goes to the library whole.
    """

    def __init__(self, path: str):
        self.library = loaded(_tokenizer, path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        rule = spec["pre_tokenizer"]
        keys = ("type", "add_prefix_space", "use_regex")
        self.by_pieces = spec["normalizer"] is None and [rule.get(k) for k in keys] == ["ByteLevel", False, True]
        self.special = [t["content"] for t in spec["added_tokens"]]
        feed = self.library.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None
        self._reset()

    def _reset(self) -> None:
        # a piece stands for itself with a blank before it; the first of a text is kept with a blank, for none before it
        self.piece: dict[str, int] = defaultdict(count().__next__)
        self.part: dict[str, int] = defaultdict(count().__next__)
        self.of_piece, self.of_part = _Rows(), _Rows()
        self.open, self.chars = np.zeros(1 << 12, bool), 0

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_pieces:
            return self._whole(texts)
        if len(self.piece) > KEPT_PIECES or self.chars > KEPT_CHARS:
            self._reset()
        whole = [i for i, t in enumerate(texts) if _ONLY_PYTHON_SPACE.search(t) or any(s in t for s in self.special)]
        left, number = set(whole), self.piece.__getitem__
        at = {}
        for i, text in enumerate(texts):
            if i not in left:
                own = text.split(" ")
                own[0] = " " + own[0]
                at[i] = np.fromiter(map(number, own), np.int64, len(own))
        self._learn()
        # white space at the end of a piece, the last one aside, belongs with the blank that follows
        whole += [i for i, own in at.items() if self.open[own[:-1]].any()]
        out = dict(zip(whole, self._whole([texts[i] for i in whole]), strict=True))
        return [out[i] if i in out else self.of_piece.take(at[i])[0] for i in range(len(texts))]

    def _learn(self) -> None:
        """Ids of the pieces that were met for the first time."""
        known, number = self.of_piece.n, self.part.__getitem__
        keys = _newest(self.piece, known)
        self.open = _room(self.open, len(self.piece))
        parts, counts = [], []
        for i, key in enumerate(keys, known):
            text = key[1:] if key[:1] == " " else " " + key
            self.open[i] = text[-1:].isspace()
            self.chars += len(key)
            own = [p for run in _RUN(text) for p in _parts(run)]
            parts += map(number, own)
            counts.append(len(own))
        self._learn_parts(_newest(self.part, self.of_part.n))
        ids, lengths = self.of_part.take(np.array(parts, np.int64))
        before = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(counts, dtype=np.int64)
        self.of_piece.add(ids, np.diff(before[ends], prepend=0))

    def _learn_parts(self, parts: list[str]) -> None:
        for at in range(0, len(parts), PARTS_A_CALL):
            some = parts[at : at + PARTS_A_CALL]
            joined = self.feed is not None and not any(p.isspace() for p in some)
            if joined:
                ids = np.array(self._whole(["\n".join(some)])[0])
                feeds = np.flatnonzero(ids == self.feed)
                joined = len(feeds) == len(some) - 1
            if joined:
                lengths = np.diff(np.concatenate([[-1], feeds, [len(ids)]])) - 1
                self.of_part.add(ids[ids != self.feed], lengths)
            else:
                found = self._whole(some)
                self.of_part.add(np.concatenate(found), np.array([len(x) for x in found]))

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]


def _newest(numbered: dict[str, int], known: int) -> list[str]:
    """Keys numbered from ``known`` on, in order."""
    return list(islice(reversed(numbered), len(numbered) - known))[::-1]


def _blocks(batches, tokenizer: str, end_id: int, bits: int, block_ids: int) -> Iterator[pa.RecordBatch]:
    encoder = loaded(Encoder, tokenizer)
    shard = TaskContext.get().partitionId()
    end = np.array([end_id], dtype="<u4")
    ids, starts, parts, total, first, made = [], [], [], 0, 0, 0

    def block():
        return pa.record_batch(
            {
                "shard": pa.array([shard], pa.int32()),
                "block": pa.array([made], pa.int32()),
                "first_doc": pa.array(ids[:1], kind),
                "last_doc": pa.array(ids[-1:], kind),
                "bits": pa.array([bits], pa.int32()),
                "first_id": pa.array([first], pa.int64()),
                "n_ids": pa.array([total], pa.int64()),
                "doc_id": pa.array([ids], pa.list_(kind)),
                "doc_start": pa.array([starts], pa.list_(pa.int64())),
                "packed": pa.array([pack(np.concatenate(parts), bits)], pa.binary()),
            }
        )

    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for at in range(0, batch.num_rows, 200):
            some = batch.slice(at, 200)
            found = encoder(some.column("text").to_pylist())
            for doc_id, one in zip(some.column("doc_id").to_pylist(), found, strict=True):
                ids.append(doc_id)
                starts.append(total)
                parts += [one, end]
                total += len(parts[-2]) + 1
                if total >= block_ids:
                    yield block()
                    ids, starts, parts, total, first, made = [], [], [], 0, first + total, made + 1
    if ids:
        yield block()


def shard_starts(blocks: DataFrame) -> dict[int, int]:
    """Number of ids before each shard. One row per shard reaches the driver."""
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    starts, before = {}, 0
    for shard, n in sorted(map(tuple, totals)):
        starts[shard], before = before, before + n
    return starts


def read_packed(spark: SparkSession, path: str, crc_only: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids (array<int>) of a packed folder, or with ``crc_only`` their ids_crc32."""
    prepare(spark)
    blocks = spark.read.parquet(path)
    starts = shard_starts(blocks)
    kind = dict(blocks.dtypes)["first_doc"]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row] for name in batch.schema.names}
                bits, count = one["bits"].as_py(), one["n_ids"].as_py()
                ids = unpack(one["packed"].as_buffer(), bits, 0, count)
                edges = np.append(np.array(one["doc_start"].values, dtype=np.int64), count)
                base = starts[one["shard"].as_py()] + one["first_id"].as_py()
                spans = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
                if crc_only:
                    name, values = "ids_crc32", pa.array([zlib.crc32(ids[a:b]) for a, b in spans], pa.int64())
                else:
                    offsets = pa.array(edges, pa.int32())
                    name, values = "ids", pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                yield pa.record_batch(
                    {
                        "doc_id": one["doc_id"].values,
                        "start": pa.array(edges[:-1] + base),
                        "n_tokens": pa.array(np.diff(edges)),
                        name: values,
                    }
                )

    last = "ids_crc32 bigint" if crc_only else "ids array<int>"
    columns = blocks.select("shard", "bits", "first_id", "n_ids", "doc_id", "doc_start", "packed")
    return columns.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, {last}")


def document_ids(blocks: DataFrame, doc_id) -> np.ndarray:
    """Ids of one document, by its block and bit offset alone; None where there is no such document."""
    row = blocks.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).where(
        F.array_contains("doc_id", doc_id)
    )
    at = F.array_position("doc_id", doc_id).cast("int")
    start = F.element_at("doc_start", at)
    end = F.coalesce(F.try_element_at("doc_start", at + 1), F.col("n_ids"))
    found = row.select(start.alias("start"), end.alias("end"), "bits", "packed").first()
    return None if found is None else unpack(bytes(found.packed), found.bits, found.start, found.end - found.start)


def round_trip(docs: DataFrame, tokenizer: str = BYTE_BPE, end_id: int = END_ID) -> DataFrame:
    """Write the packed files to the shared folder and read them back as digests."""
    spark = docs.sparkSession
    path = fresh_path(spark, "packed-ids")
    write_packed(docs, path, tokenizer, end_id)
    return read_packed(spark, path, crc_only=True)
