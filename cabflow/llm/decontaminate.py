"""Benchmark decontamination with suffix arrays of the training texts.

A task takes its documents in shards of a few megabytes. The words of a shard become numbers (their
place in the benchmark's vocabulary, or 0), with a 0 between documents. Only a place from which
at least as many benchmark words follow as the shortest window has can begin a match, so the shard's
suffix array holds those suffixes alone, sorted by their first ``WINDOW`` words. Every suffix of
every benchmark item is then binary-searched in it: the interval of suffixes that begin with the same
window gives all its locations in the shard. Neighbouring hits on one diagonal join to the longest
verbatim matches.

No document is shuffled. The benchmark is staged in blocks of ``BLOCK_ITEMS`` items in the shared
folder; a task holds a few blocks at a time, so a benchmark of any size is searched whole.

Defined results: a null or empty text (or item) has no word and no match; an item of fewer words than
the window is one window; an item with a null id marks words and is listed as "null"; rows that
repeat an item id count as one item, and rows that repeat a document are each judged; empty tables
give no matches or no rows; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm import common
from cabflow.llm import kernels as k
from cabflow.session import scratch_dir

WINDOW = 10
BLOCK_ITEMS = 5000
SHARD_BYTES = 4 << 20
MATCH = "struct<item_id:string,doc_start:long,item_start:long,n_words:long>"
SCHEMA = f"doc_id long, n_words long, n_hit long, items array<string>, matches array<{MATCH}>"


class Block(NamedTuple):
    """Benchmark items, ready to search."""

    ids: list[str]
    vocabulary: np.ndarray  # sorted word hashes
    low: np.ndarray  # first and last possible key of each distinct window
    high: np.ndarray
    size: np.ndarray  # words in each distinct window
    at: np.ndarray  # occurrences of distinct window i in the items: [at[i], at[i + 1])
    item: np.ndarray
    start: np.ndarray


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort in the order of the numbers."""
    wide = np.ascontiguousarray(rows.astype(">u4"))
    return wide.view(f"S{4 * rows.shape[1]}").ravel()


def _runs(numbers: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` numbers from each place on (0 past the end)."""
    padded = np.append(numbers, np.zeros(size, numbers.dtype))
    return padded[at[:, None] + np.arange(size)]


def make_block(ids: list, texts: pa.Array, window: int = WINDOW) -> Block:
    batch = pa.record_batch({"text": texts})
    hashes, bounds = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for c in k.chunks([batch]):
        w = k.words(k.LOWER[c.data], c.bounds, k.ALNUM)
        hashes.append(w.hash)
        bounds.append(w.bounds[1:] + bounds[-1][-1])
    h, b = np.concatenate(hashes), np.concatenate(bounds)
    vocabulary, number = np.unique(h, return_inverse=True)
    number = number + 1
    n = np.diff(b)
    windows = np.where(n >= window, n - window + 1, np.minimum(n, 1))
    item = np.repeat(np.arange(len(n)), windows)
    start = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
    size = np.minimum(n[item], window)
    rows = _runs(number, b[item] + start, window)
    rows[np.arange(window) >= size[:, None]] = 0
    found, which = np.unique(np.column_stack([size, rows]), axis=0, return_inverse=True)
    which = which.ravel()
    order = np.argsort(which, kind="stable")
    last = found[:, 1:].copy()
    last[np.arange(window) >= found[:, :1]] = 0xFFFFFFFF
    return Block(
        ["null" if i is None else str(i) for i in ids],
        vocabulary,
        _keys(found[:, 1:]),
        _keys(last),
        found[:, 0],
        np.searchsorted(which[order], np.arange(len(found) + 1)),
        item[order],
        start[order],
    )


class Hits(NamedTuple):
    """Places of a shard (word index, as numbered there) at which windows of a block occur."""

    place: np.ndarray
    window: np.ndarray


def search(block: Block, w: k.Words) -> Hits:
    """Build the shard's suffix array and look up every distinct window of the block in it."""
    none = np.zeros(0, np.int64)
    if not len(w.hash) or not len(block.size):
        return Hits(none, none)
    window = block.low.dtype.itemsize // 4
    i = np.minimum(np.searchsorted(block.vocabulary, w.hash), len(block.vocabulary) - 1)
    known = np.where(block.vocabulary[i] == w.hash, i + 1, 0)
    n_docs = len(w.bounds) - 1
    shift = w.doc()  # a 0 after each document
    numbers = np.zeros(len(known) + n_docs, np.int64)
    numbers[np.arange(len(known)) + shift] = known
    gaps = np.flatnonzero(numbers == 0)
    places = np.arange(len(known)) + shift
    ahead = np.append(gaps, len(numbers))[np.searchsorted(gaps, places)] - places
    may = np.flatnonzero(ahead >= block.size.min())
    rows = _runs(numbers, places[may], window)
    rows[np.logical_or.accumulate(rows == 0, axis=1)] = 0
    keys = _keys(rows)
    order = np.argsort(keys, kind="stable")  # the suffix array of the shard
    keys = keys[order]
    first, last = np.searchsorted(keys, block.low, "left"), np.searchsorted(keys, block.high, "right")
    n = np.maximum(last - first, 0)
    which = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return Hits(may[order][first[which] + inside], which)


def _longest(block: Block, hits: Hits, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """(doc, item, place, item start, words) of the longest matches: runs of hits on a diagonal."""
    n = np.diff(block.at)[hits.window]
    hit = np.repeat(np.arange(len(n)), n)
    use = block.at[hits.window][hit] + np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)
    place, item, start = hits.place[hit], block.item[use], block.start[use]
    order = np.lexsort((place, place - start, item, doc[place]))
    place, item, start, size = place[order], item[order], start[order], block.size[hits.window][hit][order]
    new = np.ones(len(place), bool)
    new[1:] = (
        (place[1:] != place[:-1] + 1)
        | (item[1:] != item[:-1])
        | (place[1:] - start[1:] != place[:-1] - start[:-1])
        | (doc[place[1:]] != doc[place[:-1]])
    )
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(place)) - 1
    words = place[end] + size[end] - place[begin] if len(begin) else begin
    return doc[place[begin]], item[begin], place[begin], start[begin], words


@lru_cache(maxsize=4)
def _loaded(path: str, window: int) -> Block:
    import pyarrow.parquet as pq
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    t = pq.read_table(name, filesystem=system)
    return make_block(t["item_id"].to_pylist(), t["text"].combine_chunks() if t.num_rows else pa.array([], pa.string()), window)


def stage_blocks(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_items: int = BLOCK_ITEMS
) -> list[str]:
    """Write the benchmark in blocks of at most ``block_items`` items; returns their paths."""
    spark = benchmark.sparkSession
    path = scratch_dir(spark, "benchmark")
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    items.filter("text IS NOT NULL").write.option("maxRecordsPerFile", block_items).parquet(path)
    files = spark.read.schema("item_id string, text string").parquet(path).select(F.input_file_name()).distinct().collect()
    return sorted(r[0] for r in files)


def scan_shard(chunk: k.Chunk, blocks: list[str], window: int, with_matches: bool):
    """(words, mask of hit words, item names of each document, matches of each document)."""
    w = k.words(k.LOWER[chunk.data], chunk.bounds, k.ALNUM)
    n_docs = len(chunk.bounds) - 1
    hit = np.zeros(len(w.hash), bool)
    items: list[set] = [set() for _ in range(n_docs)]
    matches: list[list] = [[] for _ in range(n_docs)]
    doc = w.doc()
    for path in blocks:
        block = _loaded(path, window)
        found = search(block, w)
        if not len(found.place):
            continue
        hit |= k.covered(len(hit), found.place, block.size[found.window])
        if with_matches:
            for d, i, p, s, n in zip(*(x.tolist() for x in _longest(block, found, doc)), strict=True):
                items[d].add(block.ids[i])
                matches[d].append((block.ids[i], p - int(w.bounds[d]), s, n))
        else:
            for d, v in np.unique(np.stack([doc[found.place], found.window], 1), axis=0).tolist():
                items[d].update(block.ids[i] for i in block.item[block.at[v] : block.at[v + 1]].tolist())
    return w, hit, items, matches


def _per_document(hit: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(hit))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_matches: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside a window that occurs), items (ids
    whose windows occur, sorted as strings) and matches (longest verbatim matches; empty on request)."""
    common.prepare(docs.sparkSession)
    blocks = stage_blocks(benchmark)

    def run(batches):
        kind = pa.list_(
            pa.struct([("item_id", pa.string()), ("doc_start", pa.int64()), ("item_start", pa.int64()), ("n_words", pa.int64())])
        )
        for c in k.chunks(batches, max_bytes=SHARD_BYTES):
            w, hit, items, matches = scan_shard(c, blocks, window, with_matches)
            yield pa.record_batch(
                {
                    "doc_id": c.rows.column("doc_id"),
                    "n_words": pa.array(np.diff(w.bounds)),
                    "n_hit": pa.array(_per_document(hit, w.bounds)),
                    "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    "matches": pa.array(
                        [[dict(zip(("item_id", "doc_start", "item_start", "n_words"), m, strict=True)) for m in ms] for ms in matches],
                        kind,
                    ),
                }
            )

    return common.texts(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The documents, all columns, in which no window of the benchmark occurs."""
    common.prepare(docs.sparkSession)
    blocks = stage_blocks(benchmark)

    def keep(batches):
        for c in k.chunks(batches, text_col, SHARD_BYTES):
            w, hit, _, _ = scan_shard(c, blocks, window, False)
            yield c.rows.filter(pa.array(_per_document(hit, w.bounds) == 0))

    return docs.mapInArrow(keep, docs.schema)
