"""Which hashes occur more than once, for far more hashes than documents.

A row per hash would cost several times the text. Here a task packs the hashes of many documents
(a *source*, bounded in size) into one row per destination, as arrays: the destination is a function
of the hash alone, so equal hashes of all sources meet there, and the answer goes back to the
source and from there to each document as the list of its places.

Hot hashes: a source sends a hash once, with how often it holds it; the answer to that one place
holds for the others, which the source keeps as a list of followers. So a destination never gets
more entries for one hash than there are sources. The answer also says whether a hash occurs more
than ``HOT`` times, so that all its holders can treat it in another way.

A document is named by (doc_id, tie): its id (never null here) and a 64-bit hash of its text. Rows
that repeat both are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm import common
from cabflow.llm import kernels as k

#: A source is closed at this much text.
SOURCE_BYTES = 48 << 20
#: Occurrences from which a hash is called hot (a source tells at most 255 of its own).
HOT = 1000
#: ``to``: destination; ``source``: where the answer goes; ``at``: packed ascending places; ``hash``
#: and ``count``: 32-bit rest of each place's hash, and how often the source holds it. On one row
#: of each source: ``ids``, ``ties`` and ``bounds``, its documents and where their places begin, and
#: ``lead``, the place that speaks for each place of ``at``. In answers a place p is 2 p, or 2 p + 1
#: if it is hot.
PACKED = "to int, source long, at binary, hash binary, count binary, ids binary, ties binary, bounds binary, lead binary"
PLACES = "doc_id long, tie long, places binary"


def squeeze(a: np.ndarray) -> bytes:
    """Ascending numbers below 2**32, as compressed differences."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.diff(a, prepend=0).astype(np.uint32).tobytes())


def unsqueeze(b: bytes) -> np.ndarray:
    import zstandard

    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint32), dtype=np.int64)


def row(schema: pa.Schema, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([values], schema=schema)


_PACKED = pa.schema(
    [("to", pa.int32()), ("source", pa.int64())] + [(n, pa.binary()) for n in ("at", "hash", "count", "ids", "ties", "bounds", "lead")]
)
_PLACES = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("places", pa.binary())])


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (never null), tie and text."""
    d = common.texts(docs, id_col, text_col)
    return d.select(common.key().alias("doc_id"), F.xxhash64("text").alias("tie"), "text")


def destination(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def runs_of_equal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a sorted array: index of each element's run, and the length of each run."""
    new = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    size = np.diff(np.append(new, len(a)))
    return np.repeat(np.arange(len(new)), size), size


def _packer(mark: Callable, n: int):
    """``mark(chunk)`` gives (units in each document as bounds, unit of each hash, hash)."""

    def pack(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list = []
        size = 0
        for c in k.chunks(batches):
            held.append((c.rows.column("doc_id").to_numpy(), c.rows.column("tie").to_numpy(), *mark(c)))
            size += len(c.data)
            if size >= SOURCE_BYTES:
                yield from _flush(held, number, n)
                held, size, number = [], 0, number + 1
        if held:
            yield from _flush(held, number, n)

    return pack


def _flush(held: list, source: int, n: int) -> Iterator[pa.RecordBatch]:
    base, bounds, at, hashes = 0, [np.zeros(1, np.int64)], [], []
    for _, _, b, a, h in held:
        bounds.append(b[1:] + base)
        at.append(a + base)
        hashes.append(h)
        base += int(b[-1])
    place, h = np.concatenate(at), np.concatenate(hashes)
    order = np.argsort(h, kind="stable")
    which, size = runs_of_equal(h[order])
    first = order[np.cumsum(size) - size]  # one place of each distinct hash
    follows = np.sort(np.setdiff1d(order, first, assume_unique=True)) if len(first) < len(order) else order[:0]
    lead = np.empty(len(h), np.int64)
    lead[order] = place[first][which]
    yield row(
        _PACKED,
        to=source % n,
        source=source,
        at=place[follows].astype(np.uint32).tobytes(),
        lead=lead[follows].astype(np.uint32).tobytes(),
        ids=np.concatenate([x[0] for x in held]).astype(np.int64).tobytes(),
        ties=np.concatenate([x[1] for x in held]).astype(np.int64).tobytes(),
        bounds=np.concatenate(bounds).astype(np.int64).tobytes(),
    )
    by_place = np.argsort(place[first], kind="stable")
    first, size = first[by_place], np.minimum(size[by_place], 255).astype(np.uint8)
    place, h = place[first], h[first]
    to = destination(h, n)
    order = np.argsort(to, kind="stable")
    ends = np.searchsorted(to[order], np.arange(n + 1))
    for t in np.flatnonzero(np.diff(ends)).tolist():
        own = order[ends[t] : ends[t + 1]]
        rest = (h[own] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        yield row(_PACKED, to=t, source=source, at=squeeze(place[own]), hash=rest.tobytes(), count=size[own].tobytes())


def _meet(batches) -> Iterator[pa.RecordBatch]:
    """At a destination: answer for the places whose hash occurs more than once."""
    to, source, at, hashes, counts = [], [], [], [], []
    for b in batches:
        for r in b.to_pylist():
            if r["hash"] is None:
                yield row(_PACKED, **r)
            else:
                to.append(r["to"])
                source.append(r["source"])
                at.append(r["at"])
                hashes.append(np.frombuffer(r["hash"], np.uint32))
                counts.append(np.frombuffer(r["count"], np.uint8))
    if not hashes:
        return
    sizes = np.array([len(x) for x in hashes])
    h = np.concatenate(hashes).astype(np.uint64) | np.repeat(np.array(to, np.uint64) << np.uint64(32), sizes)
    count = np.concatenate(counts).astype(np.int64)
    del hashes, counts
    order = np.argsort(h, kind="stable")
    which, size = runs_of_equal(h[order])
    total = np.empty(len(h), np.int64)
    total[order] = np.add.reduceat(count[order], np.cumsum(size) - size)[which]
    start = np.cumsum(sizes) - sizes
    for i in np.flatnonzero(np.add.reduceat(total > 1, start)).tolist():
        own = total[start[i] : start[i] + sizes[i]]
        places = unsqueeze(at[i])[own > 1] * 2 + (own[own > 1] > HOT)
        yield row(_PACKED, to=0, source=source[i], at=squeeze(places))


def _to_documents(batches) -> Iterator[pa.RecordBatch]:
    """At a source: the places of each document that has any."""
    places: dict[int, list[bytes]] = {}
    known: dict[int, dict] = {}
    for b in batches:
        for r in b.to_pylist():
            if r["ids"] is not None:
                known[r["source"]] = r
            else:
                places.setdefault(r["source"], []).append(r["at"])
    for source, packed in places.items():
        own = known.pop(source)
        ids, ties, bounds = (np.frombuffer(own[n], np.int64) for n in ("ids", "ties", "bounds"))
        at = np.sort(np.concatenate([unsqueeze(x) for x in packed]))
        follower, lead = (np.frombuffer(own[n], np.uint32).astype(np.int64) for n in ("at", "lead"))
        if len(follower):
            hot = at[np.searchsorted(at, lead * 2)] - lead * 2  # every lead was answered
            at = np.sort(np.concatenate([at, follower * 2 + hot]))
        ends = np.searchsorted(at, bounds * 2)
        out = [(i, at[ends[i] : ends[i + 1]] - bounds[i] * 2) for i in np.flatnonzero(np.diff(ends)).tolist()]
        for a in range(0, len(out), 1000):
            part = out[a : a + 1000]
            yield pa.record_batch(
                [
                    pa.array(ids[[i for i, _ in part]]),
                    pa.array(ties[[i for i, _ in part]]),
                    pa.array([squeeze(p) for _, p in part], pa.binary()),
                ],
                schema=_PLACES,
            )


def repeated_places(texts: DataFrame, mark: Callable) -> DataFrame:
    """``PLACES`` (2 p, or 2 p + 1 if hot) of every document that has a hash which occurs elsewhere
    too (or, once in about 2**32 hashes of a destination, seems to). ``texts`` as from
    ``keyed_texts``."""
    n = common.width(texts.sparkSession)
    return (
        texts.mapInArrow(_packer(mark, n), PACKED)
        .repartition(n, "to")
        .mapInArrow(_meet, PACKED)
        .repartition(n, "source")
        .mapInArrow(_to_documents, PLACES)
        .dropDuplicates(["doc_id", "tie"])
    )
