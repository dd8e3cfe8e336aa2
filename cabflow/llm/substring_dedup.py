"""Substring dedup on words, with difference-cover anchors.

A difference cover modulo p is a set of residues such that any two numbers have a common shift,
below p, that brings both into it. So if a run of ``window`` words occurs at two places, some
shift k < p puts both places plus k on cover positions (counted from the start of each document),
and the ``window - p + 1`` words from there, the *anchor*, lie inside both runs. It is therefore
enough to hash anchors at cover positions (four of every 13 words for a window of 20): a window
none of whose anchors occurs elsewhere occurs nowhere else.

1. Anchors whose hash occurs more than once are found, and sent back to their documents.
2. Around those only, whole windows are hashed (64 bits, and as many again as choose the
   destination), and for each hash the first occurrence is determined.
3. All words of windows that are not the first occurrence are removed.

Defined results: a null or empty text has no word; "earlier" is by id, then by a hash of the text
(for different texts with one id), then by place; rows that repeat both id and text are one
document and get the same answer; a null id sorts first and stays null; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cabflow.llm import common
from cabflow.llm import kernels as k
from cabflow.llm.anchors import (
    PLACES,
    SOURCE_BYTES,
    destination,
    keyed_texts,
    repeated_places,
    row,
    runs_of_equal,
    squeeze,
    unsqueeze,
)

WINDOW = 20
# Perfect difference sets, by modulus.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

WINDOWS = "to int, source long, ids binary, ties binary, runs binary, at binary, hash binary"
_WINDOWS = pa.schema(
    [("to", pa.int32()), ("source", pa.int64())] + [(n, pa.binary()) for n in ("ids", "ties", "runs", "at", "hash")]
)


def period(window: int) -> int:
    """The modulus: as large as leaves anchors of at least a third of the window."""
    return max(p for p in COVERS if p <= max(1, 2 * window // 3))


def anchors_of(window: int):
    """Marks the anchors of a chunk: (words of each document as bounds, word, hash)."""
    p = period(window)
    size = window - p + 1
    cover = np.zeros(p, bool)
    cover[list(COVERS[p])] = True

    def mark(chunk: k.Chunk):
        w = k.words(chunk.data, chunk.bounds, k.NON_SPACE)
        at, h = k.windows(w, size)
        inside = at - w.bounds[:-1][np.searchsorted(w.bounds, at, "right") - 1]
        on = cover[inside % p]
        return w.bounds, at[on], h[on]

    return mark


def _candidates(window: int, n: int):
    """Windows around repeated anchors, packed by destination; repeats within the source at once."""
    reach = period(window)

    def pack(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list = []
        size = 0
        for c in k.chunks(batches):
            w = k.words(c.data, c.bounds, k.NON_SPACE)
            at, h = k.windows(w, window)
            anchors = [(unsqueeze(x) >> 1) + w.bounds[i] for i, x in enumerate(c.rows.column("places").to_pylist())]
            near = np.zeros(len(w.hash) + reach + 1, np.int32)
            near[np.concatenate(anchors)] = 1
            before = np.append(0, np.cumsum(near))
            on = before[at + reach] > before[at]
            at, h = at[on], h[on]
            to = destination(k.run_of_hashes(w.hash, window, at, k.WORD_BASE_2), n)
            doc = np.searchsorted(w.bounds, at, "right") - 1
            ids, ties = c.rows.column("doc_id").to_numpy(), c.rows.column("tie").to_numpy()
            held.append((ids[doc], ties[doc], at - w.bounds[doc], h, to))
            size += len(at) * 16
            if size >= SOURCE_BYTES:
                yield from _flush(held, number, n)
                held, size, number = [], 0, number + 1
        if held:
            yield from _flush(held, number, n)

    return pack


def _pack(ids, ties, at) -> dict[str, bytes]:
    """Sorted occurrences with the documents run-length coded."""
    new = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])])
    runs = np.diff(np.append(new, len(ids)))
    return {
        "ids": ids[new].tobytes(),
        "ties": ties[new].tobytes(),
        "runs": runs.astype(np.uint32).tobytes(),
        "at": at.astype(np.uint32).tobytes(),
    }


def _unpack(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    runs = np.frombuffer(r["runs"], np.uint32)
    ids, ties = (np.repeat(np.frombuffer(r[n], np.int64), runs) for n in ("ids", "ties"))
    return ids, ties, np.frombuffer(r["at"], np.uint32).astype(np.int64)


def _later(ids, ties, at, to, h) -> tuple[np.ndarray, np.ndarray]:
    """(order, mask in that order of occurrences that are not the first of their hash)."""
    order = np.lexsort((at, ties, ids, h, to))
    same = (h[order][1:] == h[order][:-1]) & (to[order][1:] == to[order][:-1])
    first = np.flatnonzero(np.r_[True, ~same])
    lead = order[np.repeat(first, np.diff(np.append(first, len(order))))]
    own = order
    return order, (ids[own] != ids[lead]) | (ties[own] != ties[lead]) | (at[own] != at[lead])


def _flush(held: list, source: int, n: int) -> Iterator[pa.RecordBatch]:
    ids, ties, at, h, to = (np.concatenate(x) for x in zip(*held, strict=True))
    if not len(ids):
        return
    order, later = _later(ids, ties, at, to, h)
    known = order[later]
    if len(known):
        known = known[np.lexsort((at[known], ties[known], ids[known]))]
        yield row(_WINDOWS, to=source % n, source=source, **_pack(ids[known], ties[known], at[known]))
    _, size = runs_of_equal(np.cumsum(np.r_[True, (h[order][1:] != h[order][:-1]) | (to[order][1:] != to[order][:-1])]))
    first = order[np.cumsum(size) - size]
    first = first[np.lexsort((at[first], ties[first], ids[first], to[first]))]
    ends = np.searchsorted(to[first], np.arange(n + 1))
    for t in np.flatnonzero(np.diff(ends)).tolist():
        own = first[ends[t] : ends[t + 1]]
        yield row(_WINDOWS, to=t, source=source, **_pack(ids[own], ties[own], at[own]), hash=h[own].tobytes())


def _first_of_all(batches) -> Iterator[pa.RecordBatch]:
    """At a destination: pass on the occurrences that come after another source's."""
    to, source, parts, hashes = [], [], [], []
    for b in batches:
        for r in b.to_pylist():
            if r["hash"] is None:
                yield row(_WINDOWS, **r)
            else:
                parts.append(_unpack(r))
                hashes.append(np.frombuffer(r["hash"], np.uint64))
                to.append(r["to"])
                source.append(r["source"])
    if not parts:
        return
    sizes = np.array([len(x) for x in hashes])
    ids, ties, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    order, later = _later(ids, ties, at, np.repeat(np.array(to, np.int64), sizes), np.concatenate(hashes))
    mask = np.zeros(len(ids), bool)
    mask[order[later]] = True
    start = np.cumsum(sizes) - sizes
    for i in np.flatnonzero(np.add.reduceat(mask, start)).tolist():
        own = slice(start[i], start[i] + sizes[i])
        on = mask[own]
        yield row(_WINDOWS, to=0, source=source[i], **_pack(ids[own][on], ties[own][on], at[own][on]))


def _removed(batches) -> Iterator[pa.RecordBatch]:
    """At a source: the removed windows of each document."""
    parts: dict[int, list] = {}
    for b in batches:
        for r in b.to_pylist():
            parts.setdefault(r["source"], []).append(_unpack(r))
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("places", pa.binary())])
    for own in parts.values():
        ids, ties, at = (np.concatenate(x) for x in zip(*own, strict=True))
        order = np.lexsort((at, ties, ids))
        ids, ties, at = ids[order], ties[order], at[order]
        new = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])])
        ends = np.append(new, len(ids))
        for a in range(0, len(new), 1000):
            i = new[a : a + 1000]
            places = [squeeze(at[x:y]) for x, y in zip(ends[a:].tolist(), ends[a + 1 : a + 1 + len(i)].tolist(), strict=False)]
            yield pa.record_batch([pa.array(ids[i]), pa.array(ties[i]), pa.array(places, pa.binary())], schema=schema)


def repeated_windows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``PLACES``: the words of each document at which a window starts that occurs earlier."""
    n = common.width(texts.sparkSession)
    near = texts.join(repeated_places(texts, anchors_of(window)).hint("shuffle_hash"), ["doc_id", "tie"])
    return (
        near.mapInArrow(_candidates(window, n), WINDOWS)
        .repartition(n, "to")
        .mapInArrow(_first_of_all, WINDOWS)
        .repartition(n, "source")
        .mapInArrow(_removed, PLACES)
        .dropDuplicates(["doc_id", "tie"])
    )


def keep_words(chunk: k.Chunk, w: k.Words, keep: np.ndarray) -> pa.Array:
    """Texts of the kept words, joined by one space."""
    data = np.append(chunk.data, np.uint8(0x20))
    start, end = w.start[keep], w.end[keep] + 1
    size = end - start
    to = np.cumsum(size)
    out = data[np.repeat(start - (to - size), size) + np.arange(to[-1] if len(to) else 0)]
    out[to - 1] = 0x20  # the place after each word
    kept = np.append(0, np.cumsum(keep))[w.bounds]  # kept words before each document
    off = np.append(0, to)[kept]
    raw = out.tobytes()
    return pa.array([raw[a : max(a, b - 1)] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.binary())


def _cutter(window: int):
    def cut(batches) -> Iterator[pa.RecordBatch]:
        for c in k.chunks(batches):
            w = k.words(c.data, c.bounds, k.NON_SPACE)
            starts = [unsqueeze(x) + w.bounds[i] for i, x in enumerate(c.rows.column("places").to_pylist()) if x is not None]
            gone = k.covered(len(w.hash), np.concatenate(starts), window) if starts else np.zeros(len(w.hash), bool)
            sums = np.append(0, np.cumsum(gone))
            yield pa.record_batch(
                {
                    "doc_id": c.rows.column("doc_id"),
                    "n_words": pa.array(np.diff(w.bounds)),
                    "n_removed": pa.array(sums[w.bounds[1:]] - sums[w.bounds[:-1]]),
                    "kept": keep_words(c, w, ~gone).cast(pa.string()),
                }
            )

    return cut


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and the kept text."""
    common.prepare(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col)
    found = common.stage(repeated_windows(texts, window), "repeated-windows")
    out = (
        texts.join(found.hint("shuffle_hash"), ["doc_id", "tie"], "left")
        .select("doc_id", "text", "places")
        .mapInArrow(_cutter(window), "doc_id long, n_words long, n_removed long, kept string")
    )
    return out.withColumn("doc_id", common.unkey("doc_id"))
