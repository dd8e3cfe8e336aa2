"""SimHash near-duplicates: fingerprints at a small Hamming distance, compared bit plane by bit plane.

A text is lower-cased (A-Z), cut into words at white space and hashed by its 3-word shingles (XXH64,
seed 42; a text of fewer words is one shingle). A bit of the fingerprint is 1 if it is set in more than
half of the hashes. Equal fingerprints are one node; nodes at ``RADIUS`` or fewer differing bits are linked.

Which nodes meet. The 64 bits are cut into ``RADIUS`` + 1 blocks; linked nodes agree on one of them. So a
node goes to one bucket for each block, named by the leading bits of the block (as many as bring a bucket
to about ``BUCKET`` nodes). A bucket that still has more than ``LARGE`` nodes is refined: its pairs agree on
all bits of the block and, by the same argument, on one of four blocks of the *other* bits. A bucket whose
other bits are few is not refined, as it has few distinct nodes. All of this is exact; nothing is capped.

How they are compared. A bucket is cut into blocks of about ``TILE`` nodes and every two blocks make a tile,
so that a tile is bounded whatever the size of its bucket. In a tile the bits lie vertically: a plane
holds one bit of 64 nodes in a machine word. Plane by plane, the differences from many queries are added to
bitwise counters with a carry-save step; the last carry marks the nodes beyond the radius. A word all of
whose nodes are marked is abandoned. A tile passes on its connected components (at most one row per node),
not its pairs, so groups of copies stay linear.

Defined results: a null or empty text, or one without a word, has fingerprint zero and is linked like
any other; rows that repeat an id are documents of their own; a null id is smaller than any other and
stays null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.llm import common
from cabflow.llm import kernels as k
from cabflow.llm.near_dedup import components

SHINGLE, SEED, RADIUS = 3, 42, 3
BITS, BLOCKS = 64, RADIUS + 1
#: Nodes wanted in a bucket, in a block of a tile, and from which a bucket is refined.
BUCKET, TILE, LARGE = 1024, 4096, 1 << 17
#: A bucket with at most so many bits outside its name is not refined: it has at most 2**16 nodes.
FEW_BITS = 16
#: Salts of the join of bucket sizes with refined buckets.
SALTS = 32
#: Queries compared at once, planes between two looks at what is left, shingles counted at once.
SLAB, LOOK, COUNT = 512, 4, 1 << 17
ALL = np.uint64(2**64 - 1)
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, where those of each document begin)."""
    import xxhash

    lower = k.LOWER[data]
    w = k.words(lower, bounds, k.NON_SPACE)
    size = w.end - w.start
    at = np.append(0, np.cumsum(size + 1))  # the words, a space after each
    joined = np.full(at[-1], 0x20, np.uint8)
    joined[np.repeat(at[:-1] - (np.cumsum(size) - size), size) + np.arange(size.sum())] = lower[
        np.repeat(w.start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    ]
    n = np.diff(w.bounds)
    counts = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    to = np.append(0, np.cumsum(counts))
    first = np.arange(to[-1]) + np.repeat(w.bounds[:-1] - to[:-1], counts)
    last = np.minimum(first + SHINGLE, np.repeat(w.bounds[1:], counts))
    raw, of = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)
    return np.fromiter((of(raw[a:b], SEED) for a, b in spans), np.uint64, len(first)), to


def fingerprints(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each document the bits that more than half of its hashes have."""
    n = np.diff(bounds)
    ones = np.zeros((len(n), BITS), np.int64)
    for at in range(0, len(h), COUNT):
        part = h[at : at + COUNT]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        lo = int(np.searchsorted(bounds, at, "right")) - 1
        hi = int(np.searchsorted(bounds, at + len(part), "left"))
        own = np.arange(lo, hi)
        own = own[n[own] > 0]
        ones[own] += np.add.reduceat(bits, np.maximum(bounds[own] - at, 0), axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _fingerprinter(batches) -> Iterator[pa.RecordBatch]:
    for c in k.chunks(batches):
        fp = fingerprints(*shingle_hashes(c.data, c.bounds))
        yield pa.record_batch({"doc_id": c.rows.column("doc_id"), "fp": pa.array(fp.view(np.int64))})


@lru_cache
def named_bits(path: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(bits that name a bucket, other bits). A path tells the block chosen at each level: a 1, then a digit
    to base ``BLOCKS`` for each level."""
    if path == 1:
        return (), tuple(range(BITS))
    chosen, rest = named_bits(path // BLOCKS)
    parts = [tuple(x.tolist()) for x in np.array_split(np.array(rest), BLOCKS)]
    own = parts[path % BLOCKS]
    return chosen + own, tuple(b for b in rest if b not in own)


def last_level() -> int:
    """The level at which no bucket is refined."""
    level = 1
    while len(named_bits(2 * BLOCKS**level - 1)[1]) > FEW_BITS:
        level += 1
    return level


def _refiner(batches) -> Iterator[pa.RecordBatch]:
    """A row (path, value, fp) of a large bucket becomes one for each block of its other bits."""
    for b in batches:
        paths, fps = b.column("path").to_numpy(), b.column("fp").to_numpy().view(np.uint64)
        for path in np.unique(paths).tolist():
            own = fps[paths == path]
            for digit in range(BLOCKS):
                value = np.zeros(len(own), np.uint64)
                for bit in named_bits(path * BLOCKS + digit)[0]:
                    value = value << np.uint64(1) | own >> np.uint64(bit) & np.uint64(1)
                yield pa.record_batch(
                    {
                        "path": pa.array(np.full(len(own), path * BLOCKS + digit, np.int32)),
                        "value": pa.array(value.view(np.int64)),
                        "fp": pa.array(own.view(np.int64)),
                    }
                )


def _words_of(bits: np.ndarray) -> np.ndarray:
    """(plane, node) of 0 and 1 as (plane, word): 64 nodes in a machine word."""
    padded = np.zeros((bits.shape[0], -(-bits.shape[1] // 64) * 64), np.uint8)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def near_pairs(queries: np.ndarray, nodes: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) indexes of all pairs at ``radius`` or fewer differing bits, in portions."""
    if not len(queries) or not len(nodes):
        return
    varies = int(np.bitwise_or.reduce(np.concatenate([queries, nodes]) ^ nodes[0]))
    bits = np.array([b for b in range(BITS) if varies >> b & 1], np.uint64)
    planes = _words_of((nodes >> bits[:, None] & np.uint64(1)).astype(np.uint8))
    width = -(-len(nodes) // 64)
    beyond = ~_words_of(np.ones((1, len(nodes)), np.uint8))[0]  # places after the last node
    digits = max(1, radius.bit_length())
    for at in range(0, len(queries), SLAB):
        slab = queries[at : at + SLAB]
        asked = ~((slab >> bits[:, None] & np.uint64(1)) - np.uint64(1))  # (plane, query): all ones or none
        # Counters of ``digits`` bits start so high that they overflow at radius + 1.
        start = (1 << digits) - 1 - radius
        count = [np.full((len(slab), width), ALL if start >> d & 1 else 0, np.uint64) for d in range(digits)]
        over = np.repeat(beyond[None, :], len(slab), axis=0)
        row = col = None  # of the words left, once some are abandoned
        for n in range(len(bits)):
            carry = planes[n][None, :] ^ asked[n][:, None] if row is None else planes[n][col] ^ asked[n][row]
            for c in count:
                carried = c & carry
                c ^= carry
                carry = carried
            over |= carry
            if n % LOOK == LOOK - 1:
                alive = over != ALL
                left = int(alive.sum())
                if not left:
                    break
                if row is None and left * 2 < alive.size:
                    row, col = np.nonzero(alive)
                    count, over = [c[row, col] for c in count], over[row, col]
                elif row is not None and left * 2 < alive.size:
                    row, col, over = row[alive], col[alive], over[alive]
                    count = [c[alive] for c in count]
        if row is None:
            row, col = np.nonzero(over != ALL)
            over = over[row, col]
        hit = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(hit)
        if len(which):
            yield row[which] + at, col[which] * 64 + bit


def join_labels(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``label`` (of each node the least node of its component) after the links x - y are added."""
    while True:
        a, b = label[x], label[y]
        new = a != b
        if not new.any():
            return label
        x, y, a, b = x[new], y[new], a[new], b[new]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]


def _compare(tile: pa.Table) -> pa.Table:
    """The components of a tile: a link from the first node of each to the others."""
    fp = tile["fp"].to_numpy().view(np.uint64)
    own, other = tile["i"][0].as_py(), tile["j"][0].as_py()
    block = tile["block"].to_numpy()
    one, two = np.flatnonzero(block == own), np.flatnonzero(block == other)
    label = np.arange(len(fp))
    for x, y in near_pairs(fp[one], fp[two]):
        label = join_labels(label, one[x], two[y])
    on = np.flatnonzero(label != np.arange(len(fp)))
    return pa.table([pa.array(fp[label[on]].view(np.int64)), pa.array(fp[on].view(np.int64))], schema=LINK)


def _name(fp: Column, block: int, bits: int) -> Column:
    """The leading ``bits`` of one block of the fingerprint, as ``named_bits`` cuts it."""
    size = BITS // BLOCKS
    return F.shiftrightunsigned(fp, size * (block + 1) - bits).bitwiseAND(F.lit((1 << bits) - 1))


def linked(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` that have the components of all links."""
    found = []
    bits = min(BITS // BLOCKS, max(0, math.ceil(math.log2(max(1, nodes.count()) / BUCKET))))
    buckets = F.array(*[F.struct(F.lit(BLOCKS + b).alias("path"), _name(F.col("fp"), b, bits).cast("long").alias("value")) for b in range(BLOCKS)])
    members = nodes.select("fp", F.explode(buckets).alias("b")).select("b.path", "b.value", "fp")
    while True:
        sizes = members.groupBy("path", "value").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        if not found:
            # at most BLOCKS * 2**16 rows, whatever the data
            placed = members.join(F.broadcast(sizes), ["path", "value"])
        else:
            salted = sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
            salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")
            placed = members.select("*", salt.alias("salt")).join(salted, ["path", "value", "salt"]).drop("salt")
        direct = (F.col("size") <= LARGE) | (F.col("path") >= BLOCKS ** last_level())
        blocks = F.ceil(F.col("size") / TILE).cast("int")
        tiles = (
            placed.filter(direct)
            .select("path", "value", "fp", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"), blocks.alias("blocks"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"))
            .select("path", "value", "fp", "block", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"))
        )
        found.append(common.stage(tiles.groupBy("path", "value", "i", "j").applyInArrow(_compare, "a long, b long"), "simhash-links"))
        large = common.stage(placed.filter(~direct).select("path", "value", "fp"), "simhash-large")
        if large.isEmpty():
            break
        members = large.mapInArrow(_refiner, "path int, value long, fp long")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def find_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    common.prepare(docs.sparkSession)
    every = common.texts(docs, id_col, text_col).mapInArrow(_fingerprinter, "doc_id long, fp long")
    every = common.stage(every.withColumn("doc_id", common.key()), "fingerprints")
    nodes = common.stage(every.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    labels = components(linked(nodes.select("fp"))).toDF("fp", "label")
    named = nodes.join(labels, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = common.stage(named, "simhash-labels")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return every.join(named.join(least, "label").select("fp", "component_id"), "fp").select(
        common.unkey("doc_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        common.unkey("component_id").alias("component_id"),
    )
