"""Ranked lexical search: the best documents for each query text, by presence masks.

A term is a word (lower-cased A-Z). The score of a document sums, over the query's terms with repeats, a
weight of the term times a saturating function of its occurrences, both in integers (see ``weight`` and
``part_of``). All documents are ranked for every query.

1. One pass over the texts keeps of each document its length and the occurrences of terms that some query
   has (``index``); the sums over all documents follow from that table. No text is read again.
2. A task takes the index in portions. For a query, every document has a *presence mask*: a bitmap with one
   bit for each distinct term of the query. The postings of the terms are combined into masks by bit
   operations, documents are grouped by mask, and a mask has a maximum score: the sum of the largest
   parts its terms have in the portion. Masks are evaluated by descending maximum, and the query is finished as soon
   as the next maximum is below its worst kept score; equal maxima are still evaluated, as ties go by id.
   Terms whose maxima together stay below that score make no candidates (their masks would not be reached).
3. Each task passes on its best ``top`` of every query; a window over these gives the ranks.

Queries go in blocks of about ``BLOCK_BYTES`` text, one round of jobs each, so that what a task holds of the
queries is bounded. Nothing else is sent to all tasks.

Defined results: a null or empty text has no term; a query without a term, or whose terms no document has,
gives no rows; query rows that repeat both id and text are one query, and each different text of one
id is ranked for itself; documents with equal scores go by id, a null id first; rows that repeat an id are
documents of their own; an empty table gives no rows; other columns are not read. Words are compared by a
64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabflow.llm import common
from cabflow.llm import kernels as k

TOP = 20
#: Text of the queries of one round, and postings of a portion.
BLOCK_BYTES, PORTION = 4 << 20, 2_000_000
#: Documents scored at first before the next look at the bound; doubles from look to look.
FIRST_LOOK = 64
INDEX = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


class Query(NamedTuple):
    terms: np.ndarray  # numbers in the vocabulary, distinct
    times: np.ndarray  # how often the query has each


def vocabulary_of(texts: list[str | None]) -> tuple[np.ndarray, list[Query]]:
    """(sorted hashes of all terms, the queries over their numbers)."""
    hashes, bounds = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for c in k.chunks([pa.record_batch({"text": pa.array(texts, pa.large_string())})]):
        w = k.words(k.LOWER[c.data], c.bounds, k.ALNUM)
        hashes.append(w.hash)
        bounds.append(w.bounds[1:] + bounds[-1][-1])
    vocabulary, number = np.unique(np.concatenate(hashes), return_inverse=True)
    at = np.concatenate(bounds)
    return vocabulary, [Query(*np.unique(number[a:b], return_counts=True)) for a, b in zip(at[:-1], at[1:], strict=True)]


def _indexer(vocabulary: np.ndarray):
    v = max(1, len(vocabulary))

    def index(batches) -> Iterator[pa.RecordBatch]:
        for c in k.chunks(batches):
            w = k.words(k.LOWER[c.data], c.bounds, k.ALNUM)
            n_docs = len(c.bounds) - 1
            if len(vocabulary):
                i = np.minimum(np.searchsorted(vocabulary, w.hash), v - 1)
                known = vocabulary[i] == w.hash
                pairs, tf = np.unique(w.doc()[known] * v + i[known], return_counts=True)
            else:
                pairs = tf = np.zeros(0, np.int64)
            off = pa.array(np.searchsorted(pairs, np.arange(n_docs + 1) * v).astype(np.int32))
            yield pa.record_batch(
                {
                    "doc_id": c.rows.column("doc_id"),
                    "n": pa.array(np.diff(w.bounds)),
                    "terms": pa.ListArray.from_arrays(off, pa.array((pairs % v).astype(np.int32))),
                    "tfs": pa.ListArray.from_arrays(off, pa.array(tf.astype(np.int32))),
                }
            )

    return index


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def part_of(tf: np.ndarray, n: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """How much of a term's weight counts for ``tf`` occurrences in a document of ``n`` terms."""
    sizes, which = np.unique(n, return_inverse=True)
    m = np.array([100 - 25 + 25 * x * n_docs // all_terms for x in sizes.tolist()], np.int64)[which]
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Portion(NamedTuple):
    """Some documents: the postings of each term are [at[t], at[t + 1])."""

    doc_id: np.ndarray
    at: np.ndarray
    doc: np.ndarray  # ascending for each term
    value: np.ndarray  # weight times part
    most: np.ndarray  # largest value of each term

    def of(self, term: int) -> slice:
        return slice(self.at[term], self.at[term + 1])


def _portion(rows: list[pa.RecordBatch], weights: np.ndarray, n_docs: int, all_terms: int) -> Portion:
    t = pa.Table.from_batches(rows).combine_chunks()
    n = t["n"].to_numpy()
    lists = t["terms"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    tfs = t["tfs"].combine_chunks()
    if isinstance(tfs, pa.ChunkedArray):
        tfs = tfs.chunk(0)
    size = lists.value_lengths().to_numpy()
    term, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(n)), size)
    value = weights[term] * part_of(tf, n[doc], n_docs, all_terms)
    order = np.argsort(term, kind="stable")
    at = np.searchsorted(term[order], np.arange(len(weights) + 1))
    doc, value = doc[order], value[order]
    most = np.zeros(len(weights), np.int64)
    has = np.flatnonzero(np.diff(at))
    if len(has):
        most[has] = np.maximum.reduceat(value, at[has])
    return Portion(t["doc_id"].to_numpy(), at, doc, value, most)


def presence(p: Portion, terms: np.ndarray, leading: int, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents that have one of the first ``leading`` terms, their masks: (document, word of 64 terms)).
    ``scratch``: a zero for each document of the portion; left as it was."""
    for i, t in enumerate(terms[:leading].tolist()):
        scratch[p.doc[p.of(t)]] |= np.uint64(1 << i % 64) if i < 64 else np.uint64(1)
    docs = np.flatnonzero(scratch)
    masks = np.zeros((len(docs), -(-len(terms) // 64)), np.uint64)
    if leading <= 64:
        masks[:, 0] = scratch[docs]
    scratch[docs] = 0
    for i, t in enumerate(terms.tolist()):
        if i < leading <= 64:
            continue
        own = p.doc[p.of(t)]
        if not len(own):
            continue
        at = np.minimum(np.searchsorted(own, docs), len(own) - 1)
        masks[own[at] == docs, i // 64] |= np.uint64(1 << i % 64)
    return docs, masks


def group_masks(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one document of each distinct mask, the mask of each document)."""
    first, which = np.zeros(min(1, len(masks)), np.int64), np.zeros(len(masks), np.int64)
    for word in masks.T:
        _, own = np.unique(word, return_inverse=True)
        _, first, which = np.unique(which * (len(masks) + 1) + own, return_index=True, return_inverse=True)
    return first, which


class Best:
    """The best ``top`` documents of a query so far: higher scores first, then smaller ids."""

    def __init__(self, top: int):
        self.top = top
        self.score = np.zeros(0, np.int64)
        self.doc_id = np.zeros(0, np.int64)

    def least(self) -> int:
        """A document below this score is not among them (a score of 0 never is)."""
        return max(1, int(self.score[-1])) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, doc_id: np.ndarray) -> None:
        on = score >= self.least()
        score, doc_id = np.concatenate([self.score, score[on]]), np.concatenate([self.doc_id, doc_id[on]])
        order = np.lexsort((doc_id, -score))[: self.top]
        self.score, self.doc_id = score[order], doc_id[order]


def search_portion(p: Portion, query: Query, best: Best, scratch: np.ndarray) -> int:
    """Bring ``best`` up to date; returns the number of documents scored."""
    limit = query.times * p.most[query.terms]
    order = np.argsort(-limit, kind="stable")
    order = order[limit[order] > 0]
    terms, times, limit = query.terms[order], query.times[order], limit[order]
    tail = np.cumsum(limit[::-1])[::-1]  # the most that a term and all after it can give
    leading = int((tail >= best.least()).sum())
    if not leading:
        return 0
    docs, masks = presence(p, terms, leading, scratch)
    first, which = group_masks(masks)
    bits = masks[first][:, np.arange(len(terms)) // 64] >> (np.arange(len(terms)) % 64).astype(np.uint64) & np.uint64(1)
    maximum = bits.astype(np.int64) @ limit
    by_maximum = np.argsort(-maximum[which], kind="stable")
    maximum = maximum[which][by_maximum]  # of each document, descending
    done, look = 0, FIRST_LOOK
    while done < len(docs) and maximum[done] >= best.least():
        end = int(np.searchsorted(-maximum, -maximum[min(done + look, len(docs)) - 1], "right"))  # whole masks
        end = min(end, int(np.searchsorted(-maximum, -best.least(), "right")))
        own = np.sort(docs[by_maximum[done:end]])
        score = np.zeros(len(own), np.int64)
        for t, n in zip(terms.tolist(), times.tolist(), strict=True):
            with_term, value = p.doc[p.of(t)], p.value[p.of(t)]
            at = np.minimum(np.searchsorted(with_term, own), len(with_term) - 1)
            score += np.where(with_term[at] == own, n * value[at], 0)
        best.add(score, p.doc_id[own])
        done, look = end, look * 2
    return done


def _searcher(queries: list[Query], weights: np.ndarray, n_docs: int, all_terms: int, top: int):
    def search(batches) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in queries]

        def take(rows):
            p = _portion(rows, weights, n_docs, all_terms)
            scratch = np.zeros(len(p.doc_id), np.uint64)
            for query, own in zip(queries, best, strict=True):
                search_portion(p, query, own, scratch)

        held, size = [], 0
        for b in batches:
            if b.num_rows == 0:
                continue
            held.append(b)
            size += len(b.column("terms").flatten()) + b.num_rows
            if size >= PORTION:
                take(held)
                held, size = [], 0
        if held:
            take(held)
        for i, own in enumerate(best):
            if len(own.score):
                query = pa.array(np.full(len(own.score), i, np.int32))
                yield pa.record_batch([query, pa.array(own.doc_id), pa.array(own.score)], schema=FOUND)

    return search


def _rank_block(texts: DataFrame, items: DataFrame, top: int) -> DataFrame | None:
    """Ranks for the queries of one block (``item_id`` and ``text``), or None where none has a result."""
    spark = texts.sparkSession
    rows = items.collect()  # bounded: a block
    vocabulary, queries = vocabulary_of([r.text for r in rows])
    index = common.stage(texts.mapInArrow(_indexer(vocabulary), INDEX), "lexical-index")
    sums = index.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    if not sums.docs:
        return None
    weights = np.zeros(len(vocabulary), np.int64)
    for r in index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        weights[r.term] = weight(sums.docs, r.df)  # at most one row for each term of the block
    found = index.mapInArrow(_searcher(queries, weights, sums.docs, sums.terms, top), "query int, doc_id long, score long")
    by_rank = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"query int, item_id {dict(items.dtypes)['item_id']}")
    return ranked.join(F.broadcast(names), "query").select(
        "item_id", "rank", common.unkey("doc_id").alias("doc_id"), "score"
    )


def search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
) -> DataFrame:
    """The ``top`` documents of each query with a score above 0: item_id, rank (from 1), doc_id and score."""
    common.prepare(docs.sparkSession)
    texts = common.texts(docs, id_col, text_col).withColumn("doc_id", common.key())
    items = queries.select(F.col(f"`{query_id_col}`").alias("item_id"), F.col(f"`{query_text_col}`").alias("text"))
    items = items.filter("text <> ''").distinct()
    n_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-n_bytes // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for b in range(blocks):
        ranked = _rank_block(texts, items.filter(block == b), top)
        if ranked is not None:
            ranked = common.stage(ranked, "lexical-ranks") if blocks > 1 else ranked
            out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        kind = dict(items.dtypes)["item_id"]
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out
