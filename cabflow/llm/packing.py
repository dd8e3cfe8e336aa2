"""Best-fit packing of documents into sequences by length patterns.

Only lengths decide a packing, and there are at most ``capacity`` of them, so the packing is
planned on the histogram of lengths (at most ``capacity`` numbers, whatever the corpus holds):
patterns of two to four documents that fill a sequence are enumerated, non-negative least squares
fits how often each is to be used, the counts are rounded down, and what is left is packed best
fit first, again by patterns, each used until one of its lengths is used up.

The plan says which ranks of a length go to which sequences. A piece's rank among the pieces of
its length is its rank within the task that made it (counted there) plus the pieces of that
length in the tasks before (a sum over one row per task and length). So no length, however
frequent, is gathered in one task.

Defined results: a null or empty text is the end id alone; a document longer than the capacity is
cut into full pieces and a rest; a piece of full length has a sequence to itself; rows that repeat
an id are packed each on their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabflow.llm import common
from cabflow.llm import kernels as k
from cabflow.llm.token_files import crc_of_lists, with_end
from cabflow.llm.tokens import Encoder

CAPACITY = 2048
#: Patterns of three and four documents that are enumerated at most (all of two are).
MAX_PATTERNS = 12_000
NNLS_STEPS = 1500
PIECE_SCHEMA = "part int, doc_id long, piece int, start long, length int, nth long, ids_crc32 long, ids array<int>"


class Plan(NamedTuple):
    """Segments, sorted by (length, first rank): ranks [first, first + n) of a length go to the
    sequences sequence, sequence + 1, ... at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def enumerate_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns of up to four present lengths (padded by 0) that fill a sequence exactly, or, for
    pairs, as far as any present length does."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    below = np.maximum.accumulate(np.where(have, np.arange(capacity + 1), 0))  # largest present, at most i
    small = lengths[lengths < capacity]
    pairs = np.stack([small, below[capacity - small]], 1)
    pairs = np.sort(pairs[pairs[:, 1] > 0], 1)[:, ::-1]
    out = [np.pad(np.unique(pairs, axis=0), ((0, 0), (0, 2)))]
    budget = MAX_PATTERNS
    for docs in (3, 4):
        n = len(small)
        if n == 0:
            break
        # An even grid over the free lengths; the last document is the one that completes the sum.
        per_axis = max(1, int((budget * 4) ** (1 / (docs - 1))))
        grid = small[np.unique(np.linspace(0, n - 1, min(n, per_axis)).astype(int))]
        free = np.stack(np.meshgrid(*[grid] * (docs - 1), indexing="ij"), -1).reshape(-1, docs - 1)
        rest = capacity - free.sum(1)
        ok = (rest > 0) & (free[:, :-1] >= free[:, 1:]).all(1)
        free, rest = free[ok], rest[ok]
        ok = have[rest]
        full = np.sort(np.column_stack([free[ok], rest[ok]]), 1)[:, ::-1]
        full = np.unique(full, axis=0) if len(full) else full
        if len(full) > budget:
            full = full[np.linspace(0, len(full) - 1, budget).astype(int)]
        if len(full):
            out.append(np.pad(full, ((0, 0), (0, 4 - docs))))
    return np.concatenate(out).astype(np.int64)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative least squares: repeat counts x with sum of patterns close to the histogram,
    by accelerated projected gradient on relative errors."""
    weight = 1 / np.sqrt(histogram + 1.0)
    weight[0] = 0
    used = patterns > 0
    per_length = np.bincount(patterns[used], minlength=len(histogram))
    step = 1 / max(1.0, float(4 * (per_length * weight**2).max()))
    size = len(histogram)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(NNLS_STEPS):
        made = np.bincount(patterns.ravel(), np.repeat(y, patterns.shape[1]), size)
        pull = (made - histogram) * weight**2
        pull[0] = 0
        new = np.maximum(0, y - step * pull[patterns].sum(1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def make_plan(histogram: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """``histogram[n]``: pieces of length n, for n up to ``capacity``."""
    left = histogram.astype(np.int64).copy()
    chosen: list[tuple[list[int], int]] = []

    def take(pattern: list[int], times: int) -> None:
        chosen.append((pattern, times))
        for n in pattern:
            left[n] -= times

    def possible(pattern: list[int]) -> int:
        return min(int(left[n]) // pattern.count(n) for n in pattern)

    if left[capacity]:
        take([capacity], int(left[capacity]))
    lengths = np.flatnonzero(left)
    if len(lengths):
        patterns = enumerate_patterns(lengths, capacity)
        if len(patterns):
            counts = np.floor(fit_counts(patterns, left.astype(float)) + 1e-6).astype(np.int64)
            for i in np.argsort(-counts, kind="stable"):
                if counts[i] == 0:
                    break
                pattern = [int(n) for n in patterns[i] if n]
                times = min(int(counts[i]), possible(pattern))
                if times:
                    take(pattern, times)
    while len(present := np.flatnonzero(left)):  # best fit on what is left
        pattern, space = [], capacity
        while space:
            i = int(np.searchsorted(present, space, "right")) - 1
            while i >= 0 and pattern.count(int(present[i])) >= left[present[i]]:
                i -= 1
            if i < 0:
                break
            pattern.append(int(present[i]))
            space -= pattern[-1]
        take(pattern, possible(pattern))

    rank = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for pattern, times in chosen:
        offset = 0
        for n in pattern:
            rows.append((n, int(rank[n]), sequence, offset))
            rank[n] += times
            offset += n
        sequence += times
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 4)
    return Plan(a[:, 0], a[:, 1], a[:, 2], a[:, 3], sequence)


def _cutter(tokenizer_path: str, end_id: int, capacity: int):
    def cut(batches):
        encoder, part = Encoder.of(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for c in k.chunks(batches):
            ids, bounds = with_end(*encoder.encode(c.data, c.bounds), end_id)
            n_docs = np.diff(bounds)
            n_pieces = -(-n_docs // capacity)
            doc = np.repeat(np.arange(len(n_docs)), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(n_docs[doc] - start, capacity)
            order = np.argsort(length, kind="stable")
            by_length = length[order]
            run = np.flatnonzero(np.r_[True, by_length[1:] != by_length[:-1]])
            nth = np.empty(len(doc), np.int64)
            nth[order] = np.arange(len(doc)) - np.repeat(run, np.diff(np.append(run, len(doc)))) + seen[by_length]
            seen += np.bincount(length, minlength=capacity + 1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(bounds[doc] + start, bounds[-1]).astype(np.int32)), pa.array(ids.view(np.int32))
            )
            yield pa.record_batch(
                {
                    "part": pa.array(np.full(len(doc), part, np.int32)),
                    "doc_id": c.rows.column("doc_id").take(pa.array(doc)),
                    "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start),
                    "length": pa.array(length.astype(np.int32)),
                    "nth": pa.array(nth),
                    "ids_crc32": crc_of_lists(lists),
                    "ids": lists,
                }
            )

    return cut


def _placer(plan: Plan):
    key = plan.length << 40 | plan.first

    def place(batches):
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy().astype(np.int64)
            rank = b.column(b.schema.get_field_index("rank")).to_numpy()
            i = np.searchsorted(key, length << 40 | rank, "right") - 1
            keep = {n: b.column(b.schema.get_field_index(n)) for n in ("doc_id", "piece", "start")}
            yield pa.record_batch(
                keep
                | {
                    "length": pa.array(length),
                    "sequence_id": pa.array(plan.sequence[i] + rank - plan.first[i]),
                    "offset": pa.array(plan.offset[i]),
                    "ids_crc32": b.column(b.schema.get_field_index("ids_crc32")),
                }
            )

    return place


def cut_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces with their ids, as a staged table (``PIECE_SCHEMA``)."""
    common.prepare(docs.sparkSession)
    cut = _cutter(tokenizer_path, end_id, capacity)
    return common.stage(common.texts(docs, id_col, text_col).mapInArrow(cut, PIECE_SCHEMA), "pieces")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, sequence_id, offset and ids_crc32 of each piece. The ids
    themselves stay in the staged files."""
    sizes = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        histogram[r.length] = r.n
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.drop("ids").join(base, ["part", "length"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth")).drop("base", "nth", "part")
    return ranked.mapInArrow(
        _placer(make_plan(histogram, capacity)),
        "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids_crc32 long",
    )


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, **cols: str) -> DataFrame:
    """Cut and place the documents; see ``place`` for the columns."""
    return place(cut_pieces(docs, tokenizer_path, capacity, end_id, **cols), capacity)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids (at most ``capacity``)."""
    ids = placed.join(pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    return ids.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids")
    )
