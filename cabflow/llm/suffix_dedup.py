"""Suffix dedup on bytes: every byte of a string of ``length`` bytes that occurs twice is removed.

Sorting all suffixes takes many times the text on disk, so only a sample is carried, as
in induced sorting, where the order of a few locally determined suffixes settles the others:

1. *Sample.* In every run of ``length`` bytes the leftmost smallest hash of ``NAME`` bytes is
   chosen. The choice depends on the run alone, so equal strings choose the same suffix; about one
   suffix in 65 is ever chosen. The hash names it.
2. *Names.* Suffixes whose name occurs once are done: no string that chose them occurs again.
3. *Induction.* Of the others, the bytes that all strings choosing it cover go to where its name
   is settled, packed and compressed. There each string is compared through its chosen suffix, and
   what is repeated goes back as ranges of places. All shuffles are Spark's, on disk.

Hot names: of equal byte ranges a source sends one. For a name with more than ``anchors.HOT``
occurrences the strings do not meet at the name but each at the hash of its own bytes, so that
a passage that a third of all documents share is spread like any other text.

Defined results: a null or empty text has no byte; rows that repeat an id (or both id and text) are
documents like any other, so a text of at least ``length`` bytes in two rows is removed from both;
matches do not cross documents; a null id stays null; an empty table gives no rows; the kept
bytes need not be valid UTF-8 and are binary; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cabflow.llm import common
from cabflow.llm import kernels as k
from cabflow.llm.anchors import SOURCE_BYTES, destination, keyed_texts, repeated_places, row, runs_of_equal, unsqueeze

LENGTH = 200
NAME = 72
#: Strings compared at once at a destination; bounds its memory beside the packed bytes.
BATCH_STRINGS = 2_000_000
PLACE = np.uint64((1 << 30) - 1)

#: One row per source and destination. Per document: ``ids``, ``ties`` and ``runs`` (its entries). Per
#: entry: ``begin`` (place of the first string) and ``count`` (strings, at consecutive places), and
#: either ``name`` and the bytes in ``data``, or the ``hash`` of the one string; neither: they repeat.
ENTRIES = ("ids", "ties", "runs", "begin", "count", "name", "data", "hash")
PACKED = "to int, source long, " + ", ".join(f"{n} binary" for n in ENTRIES)
_PACKED = pa.schema([("to", pa.int32()), ("source", pa.int64())] + [(n, pa.binary()) for n in ENTRIES])
RANGES = "doc_id long, tie long, begin binary, count binary"


def sample(chunk: k.Chunk, length: int) -> tuple[np.ndarray, ...]:
    """(place, name, first and last string that chooses it) of each sampled suffix of a chunk."""
    size = min(NAME, max(1, length // 2))
    n = len(chunk.data)
    none = np.zeros(0, np.int64)
    if n < length or not (np.diff(chunk.bounds) >= length).any():
        return none, none.astype(np.uint64), none, none
    prefix = k.prefix_hash(chunk.data.astype(np.uint64) + np.uint64(1), k.BYTE_BASE)
    _, inverse = k.powers(k.BYTE_BASE, n + 1)
    names = k.mix((prefix[size:] - prefix[:-size]) * inverse[: n - size + 1])
    keys = (names & ~PLACE) | np.arange(len(names), dtype=np.uint64)
    wide = length - size + 1
    rows = -(-len(keys) // wide)
    padded = np.full(rows * wide, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keys)] = keys
    grid = padded.reshape(rows, wide)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - length + 1
    chosen = (np.minimum(back[:m], ahead[wide - 1 : wide - 1 + m]) & PLACE).astype(np.int64)
    ok = np.zeros(n + 1, np.int32)
    has = np.diff(chunk.bounds) >= length
    np.add.at(ok, chunk.bounds[:-1][has], 1)
    np.add.at(ok, chunk.bounds[1:][has] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(ok)[:n])
    chosen = chosen[at]
    new = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    last = np.append(new[1:], len(at)) - 1
    return chosen[new], names[chosen[new]], at[new], at[last]


def _pack(ids, ties, begin, count) -> dict[str, bytes]:
    new = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])])
    return {
        "ids": ids[new].tobytes(),
        "ties": ties[new].tobytes(),
        "runs": np.diff(np.append(new, len(ids))).astype(np.uint32).tobytes(),
        "begin": begin.astype(np.uint32).tobytes(),
        "count": count.astype(np.uint32).tobytes(),
    }


def _unpack(r: dict) -> tuple[np.ndarray, ...]:
    runs = np.frombuffer(r["runs"], np.uint32)
    ids, ties = (np.repeat(np.frombuffer(r[n], np.int64), runs) for n in ("ids", "ties"))
    return ids, ties, *(np.frombuffer(r[n], np.uint32).astype(np.int64) for n in ("begin", "count"))


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of the given ranges, end to end."""
    to = np.cumsum(size)
    return data[np.repeat(start - (to - size), size) + np.arange(to[-1] if len(to) else 0)]


def _entries(length: int, n: int):
    """Strings that chose a repeated name, packed by destination."""

    def pack(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list = []
        size = 0
        for c in k.chunks(batches):
            place, name, first, last = sample(c, length)
            told = [unsqueeze(x) + 2 * c.bounds[i] for i, x in enumerate(c.rows.column("places").to_pylist())]
            told = np.concatenate(told)
            on = np.searchsorted(place, told >> 1)
            name, first, count = name[on], first[on], last[on] - first[on] + 1
            hot = (told & 1).astype(bool)
            prefix = k.prefix_hash(c.data.astype(np.uint64) + np.uint64(1), k.BYTE_BASE)
            doc = np.searchsorted(c.bounds, first, "right") - 1
            ids, ties = c.rows.column("doc_id").to_numpy(), c.rows.column("tie").to_numpy()
            cold = ~hot
            span = count[cold] + length - 1
            held.append(
                (
                    "data",
                    ids[doc[cold]],
                    ties[doc[cold]],
                    (first - c.bounds[doc])[cold],
                    count[cold],
                    name[cold],
                    k.spans(prefix, k.BYTE_BASE, first[cold], first[cold] + span),
                    _slices(c.data, first[cold], span),
                )
            )
            each = np.repeat(first[hot], count[hot]) + np.arange(count[hot].sum()) - np.repeat(np.cumsum(count[hot]) - count[hot], count[hot])
            doc = np.searchsorted(c.bounds, each, "right") - 1
            h = k.spans(prefix, k.BYTE_BASE, each, each + length)
            held.append(("hash", ids[doc], ties[doc], each - c.bounds[doc], np.ones(len(each), np.int64), h, h, None))
            size += int(span.sum()) + 16 * len(each)
            if size >= SOURCE_BYTES:
                yield from _flush(held, number, n, length)
                held, size, number = [], 0, number + 1
        if held:
            yield from _flush(held, number, n, length)

    return pack


def _flush(held: list, source: int, n: int, length: int) -> Iterator[pa.RecordBatch]:
    import zstandard

    zip_ = zstandard.ZstdCompressor(level=1)
    for kind in ("data", "hash"):
        own = [x[1:] for x in held if x[0] == kind]
        ids, ties, begin, count, name, content = (np.concatenate(x) for x in list(zip(*own, strict=True))[:6])
        if not len(ids):
            continue
        data = np.concatenate([x[6] for x in own]) if kind == "data" else None
        size = count + length - 1
        start = np.cumsum(size) - size
        order = np.argsort(content, kind="stable")
        which, times = runs_of_equal(content[order])
        again = np.sort(order[times[which] > 1])  # equal entries within the source: all repeat
        if len(again):
            yield row(_PACKED, to=source % n, source=source, **_pack(ids[again], ties[again], begin[again], count[again]))
        first = np.sort(order[np.cumsum(times) - times])
        to = destination(name[first], n)
        by = np.argsort(to, kind="stable")
        ends = np.searchsorted(to[by], np.arange(n + 1))
        for t in np.flatnonzero(np.diff(ends)).tolist():
            e = first[by[ends[t] : ends[t + 1]]]
            packed = _pack(ids[e], ties[e], begin[e], count[e])
            if kind == "data":
                packed["name"] = (name[e] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()
                packed["data"] = zip_.compress(_slices(data, start[e], size[e]).tobytes())
            else:
                packed["hash"] = name[e].tobytes()
            yield row(_PACKED, to=t, source=source, **packed)


def _settle(length: int):
    """At a destination: the strings that several entries hold, as ranges of places."""

    def settle(batches) -> Iterator[pa.RecordBatch]:
        import zstandard

        rows: list[dict] = []
        strings = 0
        for b in batches:
            for r in b.to_pylist():
                if r["data"] is None and r["hash"] is None:
                    yield row(_PACKED, **r)
                    continue
                rows.append(r)
                strings += int(np.frombuffer(r["count"], np.uint32).sum())
        if not rows:
            return
        parts = -(-strings // BATCH_STRINGS)
        unzip = zstandard.ZstdDecompressor()
        found: dict[int, list] = {}
        for part in range(parts):  # equal strings have one name, and so are in one part
            of, string, hashes = [], [], []
            for i, r in enumerate(rows):
                count = np.frombuffer(r["count"], np.uint32).astype(np.int64)
                if r["hash"] is not None:
                    h = np.frombuffer(r["hash"], np.uint64)
                    e = np.flatnonzero(h % np.uint64(parts) == part)
                    inside, h = np.zeros(len(e), np.int64), h[e]
                else:
                    e = np.flatnonzero(np.frombuffer(r["name"], np.uint32) % parts == part)
                    data = np.frombuffer(unzip.decompress(r["data"]), np.uint8)
                    size = count + length - 1
                    start = (np.cumsum(size) - size)[e]
                    size, many = size[e], count[e]
                    prefix = k.prefix_hash(_slices(data, start, size).astype(np.uint64) + np.uint64(1), k.BYTE_BASE)
                    inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    at = np.repeat(np.cumsum(size) - size, many) + inside
                    h = k.spans(prefix, k.BYTE_BASE, at, at + length)
                    e = np.repeat(e, many)
                of.append(np.full(len(e), i))
                string.append(e << 32 | inside)
                hashes.append(h)
            of, string, h = np.concatenate(of), np.concatenate(string), np.concatenate(hashes)
            order = np.argsort(h, kind="stable")
            which, times = runs_of_equal(h[order])
            on = np.zeros(len(h), bool)
            on[order[times[which] > 1]] = True
            of, string = of[on], string[on]
            ends = np.searchsorted(of, np.arange(len(rows) + 1))
            for i in np.flatnonzero(np.diff(ends)).tolist():
                found.setdefault(i, []).append(string[ends[i] : ends[i + 1]])
        for i, several in found.items():
            s = np.sort(np.concatenate(several))
            new = np.flatnonzero(np.r_[True, s[1:] != s[:-1] + 1])
            many = np.diff(np.append(new, len(s)))
            ids, ties, begin, _ = _unpack(rows[i])
            e, inside = s[new] >> 32, s[new] & 0xFFFFFFFF
            yield row(_PACKED, to=0, source=rows[i]["source"], **_pack(ids[e], ties[e], begin[e] + inside, many))

    return settle


def _to_documents(batches) -> Iterator[pa.RecordBatch]:
    """At a source: the repeated ranges of each document."""
    parts: dict[int, list] = {}
    for b in batches:
        for r in b.to_pylist():
            parts.setdefault(r["source"], []).append(_unpack(r))
    for own in parts.values():
        ids, ties, begin, count = (np.concatenate(x) for x in zip(*own, strict=True))
        order = np.lexsort((begin, ties, ids))
        ids, ties, begin, count = ids[order], ties[order], begin[order].astype(np.uint32), count[order].astype(np.uint32)
        new = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])])
        ends = np.append(new, len(ids))
        for a in range(0, len(new), 1000):
            cuts = list(zip(ends[a : a + 1000].tolist(), ends[a + 1 : a + 1001].tolist(), strict=False))
            i = [x for x, _ in cuts]
            yield pa.record_batch(
                {
                    "doc_id": pa.array(ids[i]),
                    "tie": pa.array(ties[i]),
                    "begin": pa.array([begin[x:y].tobytes() for x, y in cuts], pa.binary()),
                    "count": pa.array([count[x:y].tobytes() for x, y in cuts], pa.binary()),
                }
            )


def repeated_strings(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``RANGES``: runs of places of each document at which a string of ``length`` bytes starts that
    starts anywhere else too."""
    n = common.width(texts.sparkSession)

    def mark(chunk: k.Chunk):
        place, name, _, _ = sample(chunk, length)
        return chunk.bounds, place, name

    near = texts.join(repeated_places(texts, mark).hint("shuffle_hash"), ["doc_id", "tie"])
    return (
        near.mapInArrow(_entries(length, n), PACKED)
        .repartition(n, "to")
        .mapInArrow(_settle(length), PACKED)
        .repartition(n, "source")
        .mapInArrow(_to_documents, RANGES)
        .dropDuplicates(["doc_id", "tie"])
    )


def _cutter(length: int):
    def cut(batches) -> Iterator[pa.RecordBatch]:
        for c in k.chunks(batches):
            n, n_docs = len(c.data), len(c.bounds) - 1
            begin, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            told = zip(c.rows.column("begin").to_pylist(), c.rows.column("count").to_pylist(), strict=True)
            for i, (b, m) in enumerate(told):
                if b is not None:
                    begin.append(np.frombuffer(b, np.uint32) + c.bounds[i])
                    size.append(np.frombuffer(m, np.uint32) + np.int64(length - 1))
            gone = k.covered(n, np.concatenate(begin), np.concatenate(size))
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            edge = c.bounds[:-1][c.bounds[:-1] < n]
            first[edge] = gone[edge]
            removed, spans = (np.append(0, np.cumsum(x))[c.bounds] for x in (gone, first))
            kept = c.data[~gone].tobytes()
            off = (c.bounds - removed).tolist()
            yield pa.record_batch(
                {
                    "doc_id": c.rows.column("doc_id"),
                    "n_bytes": pa.array(np.diff(c.bounds)),
                    "n_removed": pa.array(np.diff(removed)),
                    "n_spans": pa.array(np.diff(spans)),
                    "kept": pa.array([kept[off[i] : off[i + 1]] for i in range(n_docs)], pa.binary()),
                }
            )

    return cut


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the
    kept bytes."""
    common.prepare(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col)
    found = common.stage(repeated_strings(texts, length), "repeated-strings")
    out = (
        texts.join(found.hint("shuffle_hash"), ["doc_id", "tie"], "left")
        .select("doc_id", "text", "begin", "count")
        .mapInArrow(_cutter(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )
    return out.withColumn("doc_id", common.unkey("doc_id"))
