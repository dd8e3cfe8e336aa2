"""Array kernels the operators run inside tasks: Arrow columns to byte chunks, words, hashes.

All of them work on a *chunk*: the UTF-8 bytes of some whole documents laid end to end, with
the offsets at which each document begins. A document is never split over two chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Fixed odd multipliers of the hashes.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
WORD_BASE_2 = 0xAF251AF3B0F025B5
MIX_1 = U64(0xBF58476D1CE4E5B9)
MIX_2 = U64(0x94D049BB133111EB)

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x = x * MIX_1
    x ^= x >> U64(27)
    x *= MIX_2
    x ^= x >> U64(31)
    return x


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n (grown on demand, kept per worker)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.full(size, U64(b), dtype=U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (out[0], out[1])
    return have


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i``; ``spans`` turns them into hashes of runs. For runs of a few
    hundred values at most: modulo 2**64 such sums are weak for long runs (two Thue-Morse strings of
    1,024 letters have equal ones whatever the base). Words and windows are hashed by ``run_hash``."""
    p, _ = powers(base, len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


def spans(prefix: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run [start, end) from its prefix sums (equal runs, equal hashes)."""
    _, inv = powers(base, len(prefix))
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(U64))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of ``a`` followed by ``b``. Not a sum: no pattern of repeats cancels out."""
    return mix(mix(a) * U64(WORD_BASE) + b)


#: Runs of more bytes are hashed by blake2b, one call each.
LONG_RUN = 64
_LOW_BYTES = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], U64)


def run_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run [start, end): two chains over its blocks of 8 bytes."""
    size = end - start
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the 8 bytes from each place on
    block = eight[start] & _LOW_BYTES[np.minimum(size, 8)]
    length = size.astype(U64)
    one = mix(block + length * U64(WORD_BASE))
    two = block * U64(WORD_BASE_2) + length
    more, at = np.flatnonzero((size > 8) & (size <= LONG_RUN)), 8
    while len(more):
        block = eight[start[more] + at] & _LOW_BYTES[np.minimum(size[more] - at, 8)]
        one[more] = mix(one[more] ^ block)
        two[more] = mix(two[more]) + block * U64(BYTE_BASE)
        at += 8
        more = more[size[more] > at]
    out = mix(one + mix(two))
    for i in np.flatnonzero(size > LONG_RUN).tolist():
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def run_of_hashes(h: np.ndarray, size: int, at: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` values from each place ``at`` on, by halves."""
    level = mix(h ^ U64(seed)) if seed else h
    out, done, width = None, 0, 1
    while True:
        if size & width:
            part = level[at + done]
            out = part if out is None else combine(out, part)
            done += width
        if done == size:
            return out
        level = combine(level[: len(level) - width], level[width:])
        width *= 2


class Chunk(NamedTuple):
    rows: pa.RecordBatch  # the documents of the chunk, whole rows
    data: np.ndarray  # uint8, their texts end to end
    bounds: np.ndarray  # int64, document i is data[bounds[i]:bounds[i + 1]]


def chunks(batches, text: str = "text", max_bytes: int = 1 << 20) -> Iterator[Chunk]:
    """Cut Arrow batches into chunks of at most ``max_bytes`` text (or one longer document).
    A null text counts as empty."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        if col.null_count:
            col = col.fill_null(b"")
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        raw = col.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1)
            to = min(to, batch.num_rows)
            yield Chunk(batch.slice(at, to - at), data[off[at] : off[to]], off[at : to + 1] - off[at])
            at = to


def text_at(chunk: Chunk, i: int) -> str:
    return chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]].tobytes().decode("utf-8", "replace")


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


# Bytes of a word, `[^\x20\x09-\x0D]+` (any script, punctuation included).
NON_SPACE = ~_table((0x20, 0x20), (0x09, 0x0D))
# Bytes of a word after lower-casing A-Z, `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
ALNUM = ~_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Words(NamedTuple):
    start: np.ndarray  # byte offsets in the chunk
    end: np.ndarray
    bounds: np.ndarray  # words of document i are [bounds[i], bounds[i + 1])
    hash: np.ndarray  # uint64

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> Words:
    """Words of a chunk: maximal runs of bytes that ``table`` marks, inside one document."""
    n = len(data)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return Words(zero, zero, np.zeros(len(bounds), np.int64), np.zeros(0, U64))
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = bounds[:-1]
    edge = edge[(edge > 0) & (edge < n)]  # a word ends where its document ends
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(start, end, np.searchsorted(start, bounds), run_hash(data, start, end))


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of every run of ``size`` words that lies in one document."""
    n = len(w.hash)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    ok = np.zeros(n + 1, np.int32)
    has = np.diff(w.bounds) >= size
    np.add.at(ok, w.bounds[:-1][has], 1)
    np.add.at(ok, w.bounds[1:][has] - size + 1, -1)
    at = np.flatnonzero(np.cumsum(ok)[:n])
    return at, run_of_hashes(w.hash, size, at)


def covered(n: int, start: np.ndarray, length) -> np.ndarray:
    """Mask of the n places that any run [start, start + length) covers."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, start, 1)
    np.add.at(d, np.minimum(start + length, n), -1)
    return np.cumsum(d[:n]) > 0
