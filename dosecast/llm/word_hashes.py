"""64-bit hashes of all words of a batch of texts, by numpy alone.

The bytes of the texts get a running polynomial sum modulo 2**64; the hash of a word is the difference of the sums at
its ends, moved to position zero by the inverse power, so equal words have equal hashes wherever they stand.
Words are runs of bytes other than ASCII white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.array([(0xBF58476D1CE4E5B9 * (b + 1) ^ 0x94D049BB133111EB * (b + 257)) & _MASK | 1 for b in range(256)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# shapes: bytes fold to lower, upper, digit; others stay. Bytes beyond ASCII count as lower-case letters
_KIND = np.arange(256, dtype=np.uint8)
_KIND[0x80:] = _KIND[ord("a") : ord("z") + 1] = ord("a")
_KIND[ord("A") : ord("Z") + 1] = ord("A")
_KIND[ord("0") : ord("9") + 1] = ord("9")


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, count: int) -> None:
        if len(cls.up) < count:
            cls.up, cls.down = _powers(_BASE, 2 * count), _powers(_INVERSE, 2 * count)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit integers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _Powers.reach(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_VALUES[codes] * _Powers.up[: len(codes)], out=total[1:])
    return mix((total[ends] - total[starts]) * _Powers.down[starts])


def hashed(texts: list[bytes], shapes: bool = False) -> tuple[np.ndarray, ...]:
    """Word hashes of all texts in a row, the first word of each text and the end; with ``shapes`` also shape hashes."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first_byte = np.concatenate([[0], np.cumsum(lengths)])
    blank = _SPACE[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(data) and not blank[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]  # the data end in a blank, so every word has an end
    firsts = np.searchsorted(starts, first_byte)
    words = _runs(data, starts, ends)
    if not shapes:
        return words, firsts
    kind = _KIND[data]
    head = np.ones(len(kind), bool)
    head[1:] = kind[1:] != kind[:-1]
    # two capitals in a row are another shape than one
    twice = (kind[1:] == ord("A")) & (kind[:-1] == ord("A"))
    head[1:] |= twice & head[:-1]
    place = np.concatenate([[0], np.cumsum(head)])
    return words, firsts, _runs(kind[head], place[starts], place[ends])


def few_at_a_time(batches: Iterator[pa.RecordBatch], rows: int = 250, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of at most ``rows`` rows and, but for single long texts, about ``size`` bytes of text."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            total = np.cumsum(lengths[at : at + rows])
            some = max(1, int(np.searchsorted(total, size, "right")))
            yield batch.slice(at, some)
            at += some
