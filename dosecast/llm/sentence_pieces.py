"""Operator 12: SentencePiece encoding and decoding by a table of distinct chunks.

No piece of the model goes on past a word into the next white-space marker, so a text falls apart at those places
into marked words (chunks: a run of markers and what follows up to the next), and its ids are those of its chunks
one after the other. Each distinct chunk is segmented once, and the ids are joined back by position:

1. Texts are read once and written as blocks of documents: the distinct chunks of the block, dealt into ``SHARDS``
   packs by hash and numbered in that order, and for each document the numbers of its chunks in their order.
2. Packs of the same shard meet in one partition, sorted by shard; each distinct chunk of a shard is given to the
   library once. The answer is one pack of ids for each pack of chunks.
3. The packs of a block join the block by its number, and every document reads its ids by position.

The blocks are written in buckets by their number, so what moves are compressed packs alone, never texts or position lists. A block closes at ``BLOCK_CHARS`` characters. A chunk has at most one
entry in each block, so a frequent word is no hot key. The table of a shard is emptied at ``KEPT_CHUNKS`` entries, which
costs a second segmentation of what comes again and changes nothing else.

The model must add a marker before the text, keep all white space, and hold no piece that crosses markers; it is
checked when loaded. Null texts are empty and have no ids. Every row gives one row; repeated rows repeat; null ids
are kept; columns other than the id and the text are not looked at. A literal marker in a text counts as a blank, as in
the library, and control symbols inside a text are ordinary text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from dosecast.llm.common import PIECE_BPE, bucketed, id_text, id_type, loaded, prepare

MARKER = "▁"
BLOCK_CHARS = 32 << 20
BLOCK_DOCS = 50_000
SHARDS = 1 << 11
KEPT_CHUNKS = 1_000_000
CHUNKS_AT_ONCE = 20_000
_CHUNKS = re.compile(f"{MARKER}+[^{MARKER}]*").findall
_PROBE = f"  a{MARKER} b\n "


class Pieces:
    """A model whose pieces cannot cross white-space markers."""

    def __init__(self, path: str):
        self.library = SentencePieceProcessor(model_file=path)
        self.size = self.library.get_piece_size()
        for i in range(self.size):
            if MARKER in self.library.id_to_piece(i).lstrip(MARKER):
                raise ValueError("a piece of the model crosses a white-space marker")
        if self.library.normalize(_PROBE) != MARKER + _PROBE.replace(" ", MARKER):
            raise ValueError("the model changes white space")
        self.marker = self.library.piece_to_id(MARKER)

    def chunks(self, text: str) -> list[str]:
        return _CHUNKS(MARKER + text.replace(" ", MARKER)) if text else []

    def segmented(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks. The library puts the first marker back."""
        found = self.library.encode([c[1:] for c in chunks], num_threads=1)
        return [ids if len(c) > 1 else [self.marker] for c, ids in zip(chunks, found, strict=True)]


def encode(docs: DataFrame, model: str = PIECE_BPE, **sizes: int) -> DataFrame:
    """doc_id and its ids as array<int>."""

    def ids(pieces: Pieces, documents: Iterator[Document]) -> dict:
        return {"ids": pa.array([doc.ids() for doc in documents], pa.list_(pa.int32()))}

    return _of_documents(docs, model, ids, "ids array<int>", **sizes)


def decode(encoded: DataFrame, model: str = PIECE_BPE) -> DataFrame:
    """doc_id and the text of its ids."""
    prepare(encoded.sparkSession)

    def run(batches):
        library = loaded(Pieces, model).library
        for batch in batches:
            texts = [library.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {id_type(encoded)}, text string")


def digests(docs: DataFrame, model: str = PIECE_BPE, **sizes: int) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def hashes(pieces: Pieces, documents: Iterator[Document]) -> dict:
        counts, of_ids, of_text = [], [], []
        for doc in documents:
            ids = doc.ids()
            counts.append(len(ids))
            of_ids.append(_sha(doc.joined()))
            of_text.append(_sha(pieces.library.decode(ids)))
        return {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(of_ids), "decoded_sha256": pa.array(of_text)}

    return _of_documents(docs, model, hashes, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", **sizes)


def _of_documents(
    docs: DataFrame, model: str, use: Callable, columns: str, block_chars: int = BLOCK_CHARS, shards: int = SHARDS
) -> DataFrame:
    prepare(docs.sparkSession)
    kind = id_type(docs)
    packs = "array<struct<shard: int, chunks: binary>>"
    schema = f"block bigint, packs {packs}, doc_id array<{kind}>, n_chunks array<int>, positions binary"
    made = id_text(docs).mapInArrow(lambda batches: chunk_blocks(batches, model, block_chars, shards), schema)
    blocks = bucketed(made, "chunks", "block")
    packed = blocks.select("block", F.explode("packs").alias("pack")).select("block", "pack.*")
    segmented = packed.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        lambda batches: segmented_packs(batches, model), "block bigint, shard int, lengths binary, ids binary"
    )
    of_block = segmented.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "lengths", "ids"))).alias("answers"))
    joined = blocks.drop("packs").join(of_block.hint("merge"), "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: Pieces = loaded(Pieces, model)
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row] for name in batch.schema.names}
                made = use(pieces, documents_of(one))
                yield pa.record_batch({"doc_id": one["doc_id"].values} | made)

    return joined.mapInArrow(run, f"doc_id {kind}, {columns}")


def chunk_blocks(batches: Iterator[pa.RecordBatch], model: str, block_chars: int, shards: int) -> Iterator[pa.RecordBatch]:
    pieces: Pieces = loaded(Pieces, model)
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32
    block = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            block = block or _Block(kind)
            block.add(doc_id.as_py(), text.as_py(), pieces)
            if block.chars >= block_chars or len(block.ids) >= BLOCK_DOCS:
                yield block.record(number, shards)
                number, block = number + 1, None
    if block:
        yield block.record(number, shards)


class _Block:
    def __init__(self, id_kind: pa.DataType):
        self.id_kind, self.chars = id_kind, 0
        self.numbers: dict[str, int] = {}
        self.ids, self.n_chunks, self.places = [], [], []

    def add(self, doc_id, text: str, pieces: Pieces) -> None:
        numbers = self.numbers
        own = [numbers.setdefault(c, len(numbers)) for c in pieces.chunks(text)]
        self.ids.append(doc_id)
        self.n_chunks.append(len(own))
        self.places.append(np.array(own, dtype=np.uint32))
        self.chars += len(text)

    def record(self, number: int, shards: int) -> pa.RecordBatch:
        chunks = list(self.numbers)
        shard = np.fromiter((zlib.crc32(c.encode("utf-8", "surrogatepass")) % shards for c in chunks), np.int32, len(chunks))
        order = np.argsort(shard, kind="stable")
        moved = np.empty(len(chunks), np.uint32)
        moved[order] = np.arange(len(chunks), dtype=np.uint32)
        places = np.concatenate(self.places) if self.places else np.zeros(0, np.uint32)
        used, first = np.unique(shard[order], return_index=True)
        packs = [
            {"shard": int(s), "chunks": pack_chunks([chunks[i] for i in own])}
            for s, own in zip(used, np.split(order, first[1:]), strict=True)
        ] if len(chunks) else []
        return pa.record_batch(
            {
                "block": pa.array([number], pa.int64()),
                "packs": pa.array([packs], pa.list_(pa.struct({"shard": pa.int32(), "chunks": pa.binary()}))),
                "doc_id": pa.array([self.ids], pa.list_(self.id_kind)),
                "n_chunks": pa.array([self.n_chunks], pa.list_(pa.int32())),
                "positions": pa.array([pack_numbers(moved[places])], pa.binary()),
            }
        )


def segmented_packs(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    """The ids of each pack; a chunk that another pack of the shard had is looked up."""
    pieces: Pieces = loaded(Pieces, model)
    known: dict[str, list[int]] = {}
    now = None
    for batch in batches:
        lengths, ids = [], []
        for shard, value in zip(batch.column("shard").to_pylist(), batch.column("chunks"), strict=True):
            if shard != now or len(known) > KEPT_CHUNKS:
                known.clear()
                now = shard
            chunks = unpack_chunks(value.as_py())
            new = [c for c in chunks if c not in known]
            for at in range(0, len(new), CHUNKS_AT_ONCE):
                some = new[at : at + CHUNKS_AT_ONCE]
                known.update(zip(some, pieces.segmented(some)))
            found = [known[c] for c in chunks]
            lengths.append(pack_numbers(np.array([len(f) for f in found], np.uint32)))
            ids.append(pack_numbers(np.array([i for f in found for i in f], np.uint32)))
        yield pa.record_batch(
            {
                "block": batch.column("block"),
                "shard": batch.column("shard"),
                "lengths": pa.array(lengths, pa.binary()),
                "ids": pa.array(ids, pa.binary()),
            }
        )


class Document:
    """One document as a list of places in the table of its block."""

    def __init__(self, places: list[int], table: list[list[int]], texts: list[str]):
        self.places, self.table, self.texts = places, table, texts

    def ids(self) -> list[int]:
        table, out = self.table, []
        for place in self.places:
            out += table[place]
        return out

    def joined(self) -> str:
        """The ids in decimal, joined by commas."""
        return ",".join(map(self.texts.__getitem__, self.places))


def documents_of(block: dict) -> Iterator[Document]:
    table: list[list[int]] = []
    for answer in block["answers"].as_py() or []:
        ids, ends = unpack_numbers(answer["ids"]).tolist(), np.cumsum(unpack_numbers(answer["lengths"]), dtype=np.int64).tolist()
        table += [ids[a:b] for a, b in zip([0, *ends], ends)]
    texts = [",".join(map(str, ids)) for ids in table]
    places = unpack_numbers(block["positions"].as_py())
    at = 0
    for n in block["n_chunks"].as_py():
        yield Document(places[at : at + n].tolist(), table, texts)
        at += n


def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, bytes of equal weight together, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def unpack_numbers(value: bytes) -> np.ndarray:
    size = int.from_bytes(value[:8], "little")
    if not size:
        return np.zeros(0, np.uint32)
    planes = np.frombuffer(pa.Codec("zstd").decompress(value[8:], size, asbytes=True), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<u4").ravel()


def pack_chunks(chunks: list[str]) -> bytes:
    """Chunks one after the other; each begins with its markers, of which one is left out between two chunks."""
    lengths = pack_numbers(np.array([len(c) for c in chunks], np.uint32))
    body = "".join(chunks).encode("utf-8", "surrogatepass")
    packed = pa.Codec("zstd").compress(body, asbytes=True)
    return b"".join([len(lengths).to_bytes(8, "little"), lengths, len(body).to_bytes(8, "little"), packed])


def unpack_chunks(value: bytes) -> list[str]:
    cut = 8 + int.from_bytes(value[:8], "little")
    ends = np.cumsum(unpack_numbers(value[8:cut]), dtype=np.int64).tolist()
    size = int.from_bytes(value[cut : cut + 8], "little")
    text = pa.Codec("zstd").decompress(value[cut + 8 :], size, asbytes=True).decode("utf-8", "surrogatepass")
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
