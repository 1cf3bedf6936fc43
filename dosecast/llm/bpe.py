"""Operator 9: BPE encoding by speculation and verification, and decoding.

A word is first cut greedily into the longest vocabulary tokens. That proposal is the BPE result exactly if
every two neighbours are compatible: merging the two tokens' symbols by rank gives the same two tokens
again. All neighbours of a batch of new words are tested at once with numpy; only words with an
incompatible pair are merged step by step.

The pair test follows both tokens' merge histories. The right edge of the left token is, in turn, each
token on its right spine, from its last symbol to the token itself; the left edge of the right token is
likewise on its left spine. Each stands until the merge that absorbs it. Two edges that stand together and have
a merge of lower rank than both absorbing merges would join across the border (at equal rank the merge
further left comes first). Ranks grow along a spine, which is checked when the tokenizer is loaded; tokens that
their own symbols do not merge to are never proposed.

Null texts are empty and have no ids. Every row gives one row; repeated rows repeat; null ids are kept.
Special token strings inside a text become their ids, as the library does by default.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dosecast.llm.common import WORD_BPE, id_text, id_type, loaded, prepare
from dosecast.llm.pretokens import WordBpe

KEPT_WORDS = 300_000
KEPT_PIECES = 100_000
NEVER = 1 << 30
#: Symbols from which a word's pairs are kept in a heap instead of looked through at each merge.
HEAP_FROM = 100
NO_MERGE = (NEVER, -1)


class Speculator:
    """Vocabulary, merges and spines of one tokenizer file."""

    def __init__(self, path: str):
        self.text = WordBpe(path)
        model = self.text.model
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.text.special.items()}
        self.size = max(self.token) + 1
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = vocab[left], vocab[right]
            self.rank[pair] = rank, vocab[left + right]
            made.setdefault(vocab[left + right], (rank, *pair))
        self.base = {t: i for t, i in vocab.items() if i not in made}
        for rank, left, right in made.values():
            if any(part in made and made[part][0] >= rank for part in (left, right)):
                raise ValueError("a merge comes before the merges that make its parts")
        keys = np.array([l << 32 | r for l, r in self.rank], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([rank for rank, _ in self.rank.values()], dtype=np.int64)[order]
        self.right_spine, self.right_until = self._spines(made, 2)
        self.left_spine, self.left_until = self._spines(made, 1)
        own = [(t, i) for t, i in vocab.items() if i in self.base.values() or self.merged(self.start(t)) == [i]]
        suffix = self.suffix
        self.inner = {t: i for t, i in own if not suffix or not t.endswith(suffix)}
        self.final = {t[: len(t) - len(suffix)]: i for t, i in own if suffix and t.endswith(suffix)}
        self.inner_lengths = _lengths(self.inner)
        self.longest_final = max(map(len, self.final), default=1)

    def _spines(self, made, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Per token the edge tokens from the token inwards, and the rank at which each is absorbed."""
        spines, untils = [[] for _ in range(self.size)], [[] for _ in range(self.size)]
        for head in self.token:
            edge, until = head, NEVER
            while edge is not None:
                spines[head].append(edge)
                untils[head].append(until)
                until, edge = (made[edge][0], made[edge][side]) if edge in made else (0, None)
        depth = max(map(len, spines))
        spine = np.full((self.size, depth), -1, dtype=np.int64)
        until = np.full((self.size, depth), -1, dtype=np.int64)
        for token, chain in enumerate(spines):
            spine[token, : len(chain)] = chain
            until[token, : len(chain)] = untils[token]
        return spine, until

    def start(self, token: str) -> list[int]:
        """Symbol ids of a vocabulary token."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            return self.symbols(token[: -len(self.suffix)])
        return [self.base[c] for c in token]

    def symbols(self, word: str) -> list[int]:
        """Symbol ids of a word; a symbol that the vocabulary lacks is left out, as the library does."""
        last = len(word) - 1
        symbols = [c + self.suffix if i == last else c for i, c in enumerate(word)]
        return [self.base[s] for s in symbols if s in self.base]

    def merged(self, ids: list[int]) -> list[int]:
        """Exact BPE: the lowest rank first, the leftmost of equals."""
        if len(ids) >= HEAP_FROM:
            return self.merged_by_heap(ids)
        known, ids = self.rank.get, list(ids)
        found = [known(p, NO_MERGE) for p in zip(ids, ids[1:])]
        while found and (best := min(found)) is not NO_MERGE:
            i = found.index(best)
            ids[i : i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = known((ids[i - 1], ids[i]), NO_MERGE)
            if i < len(found):
                found[i] = known((ids[i], ids[i + 1]), NO_MERGE)
        return ids

    def merged_by_heap(self, ids: list[int]) -> list[int]:
        """The same for words of any length: symbols are linked, and pairs wait in a heap by rank and place."""
        known, ids, n = self.rank.get, list(ids), len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(found[0], i) for i, pair in enumerate(zip(ids, ids[1:])) if (found := known(pair))]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            # a pair that a merge has changed since has another rank or none
            found = known((ids[i], ids[j])) if j >= 0 else None
            if not found or found[0] != rank:
                continue
            k = after[j]
            ids[i], ids[j], after[i] = found[1], -1, k
            if k >= 0:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right >= 0 and (found := known((ids[left], ids[right]))):
                    heapq.heappush(heap, (found[0], left))
        return [x for x in ids if x >= 0]

    def proposed(self, word: str) -> list[int] | None:
        """Longest match from the left; None where some symbol has no token."""
        inner, final, end = self.inner, self.final, len(word)
        lengths, suffix = self.inner_lengths, self.suffix
        at, out = 0, []
        while at < end:
            if end - at <= self.longest_final and (found := final.get(word[at:])) is not None:
                out.append(found)
                return out
            # the last symbol carries the end of the word, so inner tokens stop before it
            room = (end - 1 if suffix else end) - at
            for n in lengths.get(word[at : at + 3], ()) if room > 2 else ():
                if n <= room and (found := inner.get(word[at : at + n])) is not None:
                    break
            else:
                n = 2
                if room < 2 or (found := inner.get(word[at : at + 2])) is None:
                    n = 1
                    if room < 1 or (found := inner.get(word[at])) is None:
                        return None
            out.append(found)
            at += n
        return out

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays apart when their symbols are merged together."""
        good = np.ones(len(left), dtype=bool)
        a, a_until = self.right_spine[left], self.right_until[left]
        b, b_until = self.left_spine[right], self.left_until[right]
        for i in range(a.shape[1]):
            for j in range(b.shape[1]):
                rows = np.flatnonzero(good & (a[:, i] >= 0) & (b[:, j] >= 0))
                if not len(rows):
                    break
                keys = a[rows, i] << 32 | b[rows, j]
                at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
                hit = self.pair_keys[at] == keys
                rank = self.pair_ranks[at]
                crosses = hit & (rank < a_until[rows, i]) & (rank <= b_until[rows, j])
                good[rows[crosses]] = False
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words given as byte symbols."""
        guesses = [self.proposed(w) for w in words]
        lengths = np.array([len(g) if g else 0 for g in guesses])
        flat = np.array([t for g in guesses if g for t in g], dtype=np.int64)
        failed = {i for i, g in enumerate(guesses) if g is None}
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(words)), lengths)
            near = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, where = np.unique(flat[near] << 32 | flat[near + 1], return_inverse=True)
            good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[where]
            failed.update(owner[near[~good]].tolist())
        for i in failed:
            guesses[i] = self.merged(self.symbols(words[i]))
        return guesses


def _lengths(tokens: Iterable[str]) -> dict[str, tuple[int, ...]]:
    """Lengths of the tokens of three symbols or more by their first three, the longest first."""
    found: dict[str, set[int]] = {}
    for token in tokens:
        if len(token) > 2:
            found.setdefault(token[:3], set()).add(len(token))
    return {start: tuple(sorted(lengths, reverse=True)) for start, lengths in found.items()}


class Encoder:
    """Ids of whole texts; what new words of a batch give is kept for later ones."""

    def __init__(self, path: str):
        self.bpe: Speculator = loaded(Speculator, path)
        self.ids: dict[str, tuple[int, ...]] = {}
        self.of_piece: dict[str, tuple[int, ...]] = {}
        self.one = {i: i for i in self.bpe.token}  # one object per id, however many words hold it

    def __call__(self, texts: list[str]) -> list[list[int]]:
        text = self.bpe.text
        parts = [[(s, part if s else text.words(part)) for s, part in text.segments(t)] for t in texts]
        known = self.ids
        if len(known) > KEPT_WORDS:
            known.clear()
        new = set().union(*[ws for doc in parts for s, ws in doc if not s]).difference(known)
        pieces = {w: text.pieces(w) for w in new}
        of_piece = self.of_piece
        if len(of_piece) > KEPT_PIECES:
            of_piece.clear()
        distinct = list(dict.fromkeys(p for ps in pieces.values() for p in ps if p not in of_piece))
        one = self.one
        for piece, ids in zip(distinct, self.bpe.encode_words([text.symbols(p) for p in distinct]), strict=True):
            of_piece[piece] = tuple([one[i] for i in ids])
        for word, own in pieces.items():
            known[word] = of_piece[own[0]] if len(own) == 1 else tuple([i for p in own for i in of_piece[p]])
        out = []
        for doc in parts:
            ids: list[int] = []
            for special, part in doc:
                if special:
                    ids.append(text.special[part])
                else:
                    ids.extend(chain.from_iterable(map(known.__getitem__, part)))
            out.append(ids)
        return out


def encode(docs: DataFrame, tokenizer: str = WORD_BPE) -> DataFrame:
    """doc_id and its ids as array<int>."""
    prepare(docs.sparkSession)

    def run(batches):
        encoder = loaded(Encoder, tokenizer)
        for batch, ids in encoded(batches, encoder):
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return id_text(docs).mapInArrow(run, f"doc_id {id_type(docs)}, ids array<int>")


def decode(encoded_docs: DataFrame, tokenizer: str = WORD_BPE) -> DataFrame:
    """doc_id and the text of its ids, as a tokenizer without a decoder gives it: tokens joined by blanks."""
    prepare(encoded_docs.sparkSession)

    def run(batches):
        bpe: Speculator = loaded(Speculator, tokenizer)
        for batch in batches:
            texts = [bpe_text(bpe, ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(texts)})

    return encoded_docs.select("doc_id", "ids").mapInArrow(run, f"doc_id {id_type(encoded_docs)}, text string")


def digests(docs: DataFrame, tokenizer: str = WORD_BPE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; each text is encoded and its ids are decoded in one task."""
    prepare(docs.sparkSession)

    def run(batches):
        encoder = loaded(Encoder, tokenizer)
        number = {i: str(i) for i in encoder.bpe.token}
        for batch, ids in encoded(batches, encoder):
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "ids_sha256": pa.array([_sha(" ".join(map(number.__getitem__, x))) for x in ids]),
                    "decoded_sha256": pa.array([_sha(bpe_text(encoder.bpe, x)) for x in ids]),
                }
            )

    schema = f"doc_id {id_type(docs)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return id_text(docs).mapInArrow(run, schema)


def encoded(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[tuple[pa.RecordBatch, list[list[int]]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 250):
            part = batch.slice(at, 250)
            yield part, encoder(part.column("text").to_pylist())


def bpe_text(bpe: Speculator, ids: list[int]) -> str:
    return " ".join(map(bpe.token.__getitem__, ids))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
