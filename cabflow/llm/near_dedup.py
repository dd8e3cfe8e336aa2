"""Near-duplicate classes with Order MinHash, verified by banded alignment.

A text is the sequence of its 5-word shingles (lower-case words; a text of fewer words is one
shingle). Shingles are labelled by occurrence (the second "a b c d e" is another k-mer than the
first). Each of ``REPEATS`` sketches hashes all labelled k-mers and keeps the ``SAMPLED`` smallest
*in text order*; texts that share one sketch are candidates. So candidates share k-mers in the same
order, as texts of small edit distance do. (Of long texts at the threshold, a sketch is shared with
a probability of about 0.41, and none of 24 once in 300,000 pairs.)

Texts of at most ``SHORT`` shingles have exact keys besides, as a sketch of a short text misses more.
A link needs four fifths of the shingles of either text in common; so, with the k-mers of each text
sorted by hash, the two first common ones are among the first n - ceil(0.8 n) + 2 of both texts, and
every two of these are a key. (A text of one shingle is linked to such texts only, by all sketches.)

Candidates are verified by aligning the two shingle sequences inside the band that the threshold
leaves: with M aligned shingles out of a and b, the similarity is M / (a + b - M), and 0.8 or more
is a link. For texts of unique shingles in one order it is the Jaccard similarity.

A bucket (texts with one sketch) is not expanded into all its pairs:

1. Equal texts are one node. Every member of a bucket is compared with the bucket's first node, and the
   links give classes (connected components, by alternating large-star and small-star steps).
2. In a bucket with several classes left, members outside its main class become pivots, first a
   few (``PIVOTS``), then all, and are compared with all members of other classes, until every pair of
   members is in one class or has been compared. So no candidate link between different texts is
   lost, whatever the size of a bucket, and a group of copies costs as many alignments as it has
   members. To compare is first to look at the sizes and at the parity of the k-mers in ``PARITY``
   slots: every odd slot of the two texts together has a k-mer that only one of them has, and of these
   a link has few. Only what that leaves is aligned, and no link is lost by it. The first look happens
   in tiles, a block of about ``BLOCK`` pivots of a bucket against a block of as many members as arrays, and
   only pairs that pass it become rows.

All tables (sketches, pairs, links, classes) are Spark tables, staged in the shared folder.

Defined results: a class is named by its smallest doc id; equal texts are one class; texts without a
word are like no other text; a null id is smaller than any other and stays null; rows that repeat
an id are documents of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm import common
from cabflow.llm import kernels as k

SHINGLE = 5
REPEATS, SAMPLED = 24, 4
#: Texts of so many shingles have exact keys; slots in which the parity of the k-mers is kept.
SHORT, PARITY = 24, 1024
#: The threshold as a fraction, 8 / 10.
NEAR, OF = 8, 10
#: Pivots of one bucket in the first rounds, at most: few, as most of a large group joins its main class through
#: them. In the round after these, all members outside the main class are pivots.
PIVOTS = (2, 8)
#: Members, and pivots, of a bucket in one tile.
BLOCK = 4096
SKETCH = "doc_id long, node binary, n long, sketches array<long>, parity array<long>"


def shingles(w: k.Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, where those of each document begin)."""
    n = np.diff(w.bounds)
    counts = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    bounds = np.append(0, np.cumsum(counts))
    start = np.arange(bounds[-1]) + np.repeat(w.bounds[:-1] - bounds[:-1], counts)
    whole = np.repeat(n >= SHINGLE, counts)
    h = np.zeros(len(start), np.uint64)
    h[whole] = k.run_of_hashes(w.hash, SHINGLE, start[whole]) if whole.any() else 0
    for i in np.flatnonzero(~whole).tolist():
        doc = int(np.searchsorted(bounds, i, "right")) - 1
        own = w.hash[w.bounds[doc] : w.bounds[doc + 1]]
        h[i] = k.run_of_hashes(own, len(own), np.zeros(1, np.int64), k.WORD_BASE_2)[0]
    return h, bounds


def labelled(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Shingle hashes with the number of the occurrence within the document mixed in."""
    doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    own = k.mix(h + doc * np.uint64(k.WORD_BASE_2))
    order = np.argsort(own, kind="stable")
    new = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1]]) if len(h) else order
    size = np.diff(np.append(new, len(h)))
    seen = np.empty(len(h), np.uint64)
    seen[order] = np.arange(len(h)) - np.repeat(new, size)
    return k.mix(h + seen * np.uint64(k.BYTE_BASE))


def sketch(kmers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(document, repeat): hash of the sampled k-mers in text order. Documents without one: 0."""
    n = np.diff(bounds)
    out = np.zeros((len(n), REPEATS), np.uint64)
    has = np.flatnonzero(n)
    if not len(has):
        return out
    start, size = bounds[:-1][has], n[has]
    doc = np.repeat(np.arange(len(has)), size)
    for r in range(REPEATS):
        value = k.mix(kmers ^ np.uint64((r + 1) * k.WORD_BASE & (2**64 - 1)))
        places = np.full((len(has), SAMPLED), len(kmers), np.int64)
        for s in range(SAMPLED):
            least = np.minimum.reduceat(value, start)
            at = np.flatnonzero(value == least[doc])
            at = at[size[doc[at]] > s]
            places[doc[at], s] = at
            value[at] = np.uint64(0xFFFFFFFFFFFFFFFF)
        places.sort(axis=1)
        padded = np.append(kmers, np.uint64(0))
        key = np.full(len(has), np.uint64(r + 1))
        for s in range(SAMPLED):
            key = k.mix(key * np.uint64(k.WORD_BASE) + padded[places[:, s]])
        out[has, r] = key
    return out


def short_keys(kmers: np.ndarray) -> list[int]:
    """Keys of which two texts of 2 to ``SHORT`` shingles share one if they are a link."""
    n = len(kmers)
    if not 2 <= n <= SHORT:
        return []
    first = np.sort(kmers)[: n - -(-NEAR * n // OF) + 2]
    i, j = np.triu_indices(len(first), 1)
    return k.mix(k.mix(first[i]) * np.uint64(k.WORD_BASE) + first[j]).view(np.int64).tolist()


def parity(kmers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(document, word of 64 bits): whether the number of k-mers in each slot is odd."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    slot = (k.mix(kmers) >> np.uint64(32)).astype(np.int64) % PARITY
    odd = np.zeros((len(bounds) - 1, PARITY), np.uint8)
    np.bitwise_xor.at(odd, (doc, slot), 1)
    return np.packbits(odd, axis=1).view(np.int64)


def _sketcher(batches) -> Iterator[pa.RecordBatch]:
    for c in k.chunks(batches):
        h, bounds = shingles(k.words(k.LOWER[c.data], c.bounds, k.ALNUM))
        kmers = labelled(h, bounds)
        n = np.diff(bounds)
        keys = sketch(kmers, bounds).view(np.int64).tolist()
        keys = [x + short_keys(kmers[i:j]) if i < j else [] for x, i, j in zip(keys, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        yield pa.record_batch(
            {
                "doc_id": c.rows.column("doc_id"),
                "node": c.rows.column("node"),
                "n": pa.array(n),
                "sketches": pa.array(keys, pa.list_(pa.int64())),
                "parity": pa.array(parity(kmers, bounds).tolist(), pa.list_(pa.int64())),
            }
        )


def enough(matched: int, a: int, b: int) -> bool:
    """Whether ``matched`` of a and b shingles is a similarity of the threshold or more."""
    return matched * (NEAR + OF) >= NEAR * (a + b)


def aligned(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the longest common subsequence of two shingle sequences makes a link."""
    na, nb = len(a), len(b)
    m = min(na, nb)
    if not m or not enough(m, na, nb):
        return False
    differ = np.flatnonzero(a[:m] != b[:m])
    head = int(differ[0]) if len(differ) else m
    a, b = a[head:], b[head:]
    m = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:m] != b[::-1][:m])
    tail = int(differ[0]) if len(differ) else m
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    need = -(-NEAR * (na + nb) // (NEAR + OF)) - head - tail
    if need <= 0:
        return True
    band = len(a) + len(b) - 2 * need  # shingles that may be left out
    if band < 0:
        return False
    best = np.zeros(len(b) + 1, np.int32)
    for i in range(1, len(a) + 1):
        lo, hi = max(1, i - band), min(len(b), i + band)
        if lo > hi:
            continue
        step = np.where(b[lo - 1 : hi] == a[i - 1], best[lo - 1 : hi] + 1, best[lo : hi + 1])
        step = np.maximum(step, best[lo : hi + 1])
        step[0] = max(step[0], best[lo - 1])
        best[lo : hi + 1] = np.maximum.accumulate(step)
    return int(best[-1]) >= need


def _sequences(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(shingles, labelled shingles) of each text."""
    for c in k.chunks([pa.record_batch({"text": column})]):
        h, bounds = shingles(k.words(k.LOWER[c.data], c.bounds, k.ALNUM))
        kmers = labelled(h, bounds)
        for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield h[x:y], kmers[x:y]


def _verify(batches) -> Iterator[pa.RecordBatch]:
    """The pairs that are links."""
    for b in batches:
        keep = []
        both = zip(_sequences(b.column("text_a")), _sequences(b.column("text_b")), strict=True)
        for (a, la), (c, lc) in both:
            near = enough(len(np.intersect1d(la, lc, assume_unique=True)), len(a), len(c))
            keep.append(near and aligned(a, c))
        yield pa.record_batch({"a": b.column("a"), "b": b.column("b")}).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) of nodes that are links; ``texts``: node and text, one row per node."""
    a, b = (texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): each node of an edge (a, b) with the smallest node of its component."""
    e = common.stage(edges.filter("a <> b").distinct(), "edges")
    before = old = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # all edges now point from a larger node to a smaller one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.toDF("a", "b"))
        if old is not None:
            common.drop(old)
        old, e = e, common.stage(small.distinct(), "edges")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        before = now


def _candidates(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) each once, those whose sizes and parities leave a link possible."""
    once = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    a, b = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"p_{x}")) for x in "ab")
    near = (F.col("n_a") * OF >= F.col("n_b") * NEAR) & (F.col("n_b") * OF >= F.col("n_a") * NEAR)
    odd = F.aggregate(F.zip_with("p_a", "p_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    # of a and b shingles, a link has (OF - NEAR) / (NEAR + OF) or less in one text only
    alike = odd * (NEAR + OF) <= (F.col("n_a") + F.col("n_b")) * (OF - NEAR)
    return common.stage(once.join(a, "a").join(b, "b").filter(near & alike).select("a", "b"), "pairs")


def _meet(batches, once: bool = False) -> Iterator[pa.RecordBatch]:
    """Of each tile (rows sorted by bucket and block) the pairs of a pivot and a member of other classes whose sizes
    and parities leave a link possible. With ``once``, a pair that shares sketches is told by the bucket of the first
    of them alone. (For the last round: there too, one of the two is a pivot, or was one before and met the other.)"""
    pending: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([b.column("bucket").to_numpy(), b.column("block").to_numpy()], 1)
        new = (np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist()
        if pending:
            last = pending[-1]
            at = [last.column(x)[last.num_rows - 1].as_py() for x in ("bucket", "block")]
            if key[0].tolist() != at:
                new = [0, *new]
        start = 0
        for end in new:
            if end > start:
                pending.append(b.slice(start, end - start))
            yield from _tile(pending, once)
            pending, start = [], end
        pending.append(b.slice(start))
    if pending:
        yield from _tile(pending, once)


def _tile(parts: list[pa.RecordBatch], once: bool) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(parts).combine_chunks()
    is_pivot = t["is_pivot"].to_numpy()
    pivots, members = np.flatnonzero(is_pivot), np.flatnonzero(~is_pivot)
    if not len(pivots) or not len(members):
        return
    n = t["n"].to_numpy()
    odd = t["parity"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(n), -1)
    label = t["label"].combine_chunks().dictionary_encode().indices.to_numpy()
    node = t["node"].combine_chunks()
    sketches = t["firsts"].combine_chunks().flatten().to_numpy().reshape(len(n), REPEATS)
    bucket = t["bucket"][0].as_py()
    for at in range(0, len(pivots), 16):
        p = pivots[at : at + 16]
        a, b = n[p][:, None], n[members][None, :]
        may = (label[p][:, None] != label[members][None, :]) & (a * OF >= b * NEAR) & (b * OF >= a * NEAR)
        x, y = np.nonzero(may)
        # of a and b shingles, a link has (OF - NEAR) / (NEAR + OF) or less in one text only
        few = np.bitwise_count(odd[p[x]] ^ odd[members[y]]).sum(1, dtype=np.int64) * (NEAR + OF) <= (a + b)[x, y] * (OF - NEAR)
        one, two = p[x[few]], members[y[few]]
        if once:
            common_ones = sketches[one] == sketches[two]
            first = sketches[one, common_ones.argmax(1)]
            here = ~common_ones.any(1) | (first == bucket)  # texts that share only a short key are told by each
            one, two = one[here], two[here]
        if len(one):
            yield pa.record_batch({"a": node.take(pa.array(one)), "b": node.take(pa.array(two))})


def _met(open_: DataFrame, turn: DataFrame, own: DataFrame, last: bool) -> DataFrame:
    """Pairs (a, b) that a round has to align. ``open_``: members of open buckets with their label; ``turn``:
    the pivots of this round; ``last``: these are all that are left."""
    sizes = open_.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    sized = turn.groupBy("bucket").agg(F.count(F.lit(1)).alias("turns")).join(sizes, "bucket").select(
        "bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("rows"), F.ceil(F.col("turns") / BLOCK).cast("int").alias("cols"))
    columns = ["bucket", "block", "node", "label", "n", "is_pivot"]

    def dealt(df: DataFrame, own_blocks: str, other_blocks: str, row: bool) -> DataFrame:
        """Each row goes to one block of its own side, and to all blocks of the other."""
        mine = F.pmod(F.xxhash64("node"), F.col(own_blocks)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1))
        df = df.join(sized, "bucket").select("*", mine.alias("mine"), other.alias("other_block"))
        tile = F.col("mine") * F.col("cols") + F.col("other_block") if row else F.col("other_block") * F.col("cols") + F.col("mine")
        return df.withColumns({"block": tile, "is_pivot": F.lit(not row)}).select(*columns)

    members = dealt(open_.filter("node <> pivot").select("bucket", "node", "label", "n"), "rows", "cols", True)
    pivots = turn.select("bucket", F.col("a").alias("node"), F.col("other").alias("label"), F.col("m").alias("n"))
    rows = members.unionByName(dealt(pivots, "cols", "rows", False)).join(own.select("node", "parity", "firsts"), "node")
    n = common.width(own.sparkSession)
    tiles = rows.repartition(n, "bucket", "block").sortWithinPartitions("bucket", "block")
    met = tiles.mapInArrow(lambda batches: _meet(batches, last), "a binary, b binary")
    return common.stage(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")


def link_classes(sketches: DataFrame, documents: DataFrame) -> DataFrame:
    """(node, label) of the nodes that share a sketch with another node. ``sketches``: one row per
    node, staged; ``documents``: node and text of every document."""
    members = sketches.select("node", "n", F.explode("sketches").alias("bucket"))
    pivot = members.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = common.stage(members.join(pivot, "bucket").drop("size"), "buckets")
    wanted = members.select("node").distinct()
    firsts = F.slice("sketches", 1, REPEATS).alias("firsts")  # without the keys of short texts
    own = common.stage(sketches.select("node", "n", "parity", firsts).join(wanted, "node"), "sketches")
    texts = common.stage(documents.join(wanted, "node").dropDuplicates(["node"]), "candidates")
    labels = common.stage(own.select("node", F.col("node").alias("label")), "labels")

    pairs = _candidates(members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")), own)
    turned = members.select("bucket", F.col("pivot").alias("node")).distinct()  # who has been a pivot where
    for round_ in itertools.count():
        links = common.stage(verified(pairs, texts), "links")
        if not links.isEmpty():
            # Contract: only the labels that the new links join go through the components.
            ends = [labels.select(F.col("node").alias(x), F.col("label").alias(f"l_{x}")) for x in "ab"]
            edges = links.join(ends[0], "a").join(ends[1], "b").select(F.col("l_a").alias("a"), F.col("l_b").alias("b"))
            merged = components(edges).toDF("label", "root")
            joined = labels.join(merged, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
            old, labels = labels, common.stage(joined, "labels")
            common.drop(old)
        common.drop(pairs, links)
        if round_ > len(PIVOTS):  # all have been pivots
            common.drop(members, own, texts)
            return labels
        of = members.join(labels, "node")
        counts = of.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("c"))
        main = counts.groupBy("bucket").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count(F.lit(1)).alias("classes"))
        open_ = common.stage(of.join(main.filter("classes > 1").drop("classes"), "bucket"), "open")
        waiting = open_.filter("label <> main").join(turned, ["bucket", "node"], "left_anti")
        if round_ < len(PIVOTS):
            slot = F.pmod(F.xxhash64("node"), F.lit(PIVOTS[round_])).alias("slot")
            waiting = waiting.groupBy("bucket", slot).agg(F.min(F.struct("node", "label", "n")).alias("p")).select("bucket", "p.*")
        turn = common.stage(
            waiting.select("bucket", F.col("node").alias("a"), F.col("label").alias("other"), F.col("n").alias("m")), "pivots"
        )
        if turn.isEmpty():
            common.drop(open_, members, own, texts)
            return labels
        pairs = _met(open_, turn, own, round_ >= len(PIVOTS))
        common.drop(open_)
        turned = turned.unionByName(turn.select("bucket", F.col("a").alias("node")))


def node_of(text) -> F.Column:
    """Equal texts are one node: the first half of the SHA-256 of the text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id (never null), node and the label of its class."""
    common.prepare(docs.sparkSession)
    documents = common.texts(docs, id_col, text_col).select(common.key().alias("doc_id"), node_of("text").alias("node"), "text")
    every = common.stage(documents.mapInArrow(_sketcher, SKETCH), "sketches")
    # One row per distinct text: the sketches are the same for all its copies.
    nodes = every.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    one = common.stage(every.join(nodes, ["node", "doc_id"]).dropDuplicates(["node"]).drop("doc_id"), "nodes")
    labels = link_classes(one, documents.select("node", "text"))
    return every.select("doc_id", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def find_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, node, class_id (smallest doc id of its class) and class_size."""
    named = _named(docs, id_col, text_col)
    classes = named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return named.join(classes, "label").select(
        common.unkey("doc_id").alias("doc_id"), "node", common.unkey("class_id").alias("class_id"), "class_size"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with one of each class: that of smallest id, and of texts with
    this id the one of smallest node. Rows that repeat both id and text are one document."""
    per = _named(docs, id_col, text_col).groupBy("label", "doc_id", "node").agg(F.count(F.lit(1)).alias("rows"))
    kept = per.groupBy("label").agg(F.min(F.struct("doc_id", "node", "rows")).alias("k"))
    kept = common.stage(kept.select(F.col("k.doc_id").alias("__id"), F.col("k.node").alias("__node"), F.col("k.rows").alias("__rows")), "kept")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(common.NULL_ID)).alias("__id"),
        node_of(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("__node"),
    )
    on = ["__id", "__node"]
    once = rows.join(kept.filter("__rows = 1").hint("shuffle_hash"), on, "left_semi").select("row.*")
    if kept.filter("__rows > 1").isEmpty():
        return once
    again = rows.join(kept.filter("__rows > 1").hint("shuffle_hash"), on, "left_semi").dropDuplicates(on).select("row.*")
    return once.unionByName(again)
