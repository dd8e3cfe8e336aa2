"""Toxicity by class-conditional Kneser-Ney models.

Two word models, one of the texts labelled toxic and one of the ordinary ones, are compared. Their
counts are Kneser-Ney continuation counts with the document as context: in how many distinct
documents a word occurs (so one long or repetitive document weighs no more than another). Each
class's counts are discounted by an amount in proportion to its size, and what the discount takes
goes to one *shared* backoff distribution, the continuation counts of both classes together. An
expression that is rare in both classes so weighs the same in both, and speaks for neither.

The raw score of a text is the sum over its words of the difference of their log-likelihoods,
beyond a margin on either side, over the square root of its length: without the margin the many
ordinary words, each a little off, outweigh the few that matter (and so they do with word pairs,
which is why the models stop at single words; README has the figures).

The counts cover every labelled training row. They are a Spark table with a row for each distinct
word (its 64-bit hash), which grows with the corpus; the weights made of it are another, without the
words that weigh as much as one never seen. To score, a task cuts its documents into blocks, and each
distinct word of a block is one row with the documents it occurs in and how often. These rows are
joined with the weights, and what has a weight is summed by block. No model is collected or broadcast
by this module, and a word that every document has is one row a block, not one a document.

The raw score becomes a probability by a one-variable logistic fit. For it, the model of one half
of the training rows scores rows of the other half, at most ``CALIBRATION_ROWS`` in all (the only
sample that is taken).

Defined results: null and empty texts have no word and a raw score of 0; a label row with a null
id or null label is not used; a repeated label counts as toxic if any row says so; a repeated
document is scored (and, if labelled, counted) each time; without a labelled row with a word in
either class every score is 0; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.llm import common, presence
from cabflow.llm import kernels as k

#: A block is closed once it holds so many words or documents; batches are cut to so many rows.
BLOCK_WORDS, BLOCK_DOCS, BATCH_ROWS = 1 << 21, 1 << 15, 1 << 12
#: Discount of the smaller class's counts; the other's is larger as the class is.
DISCOUNT = 1.5
#: Log-likelihood ratios count by what they exceed this.
MARGIN = 1.5
#: Added to the number of words, so that the shortest texts do not score by one word alone.
LENGTH_PRIOR = 10
#: Rows that the logistic calibration is fitted on, at most.
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.7
CLASSES = (0, 1)
COUNTS = [f"n{y}{f}" for y in CLASSES for f in (0, 1)]
#: The weights: of all training rows, and of each fold.
MODELS = {"whole": (0, 1), "fold0": (0,), "fold1": (1,)}
#: One document of a word's row in a block.
ENTRY = np.dtype([("doc", "<u2"), ("times", "u1")])


def _blocks(batches) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows without their text, document, word, times) of each block: every distinct word of a
    document once, ordered by word."""
    held, docs, words = [], 0, 0
    cut = (b.slice(i, BATCH_ROWS) for b in batches for i in range(0, b.num_rows, BATCH_ROWS))
    for c in k.chunks(cut):
        w = k.words(k.LOWER[c.data], c.bounds, k.ALNUM)
        # fewer than 2**16 documents are in a block
        held.append((c.rows.drop_columns(["text"]), (w.doc() + docs).astype(np.uint16), w.hash))
        docs += c.rows.num_rows
        words += len(w.hash)
        if words >= BLOCK_WORDS or docs >= BLOCK_DOCS:
            yield _block(held)
            docs = words = 0
    if held:
        yield _block(held)


def _block(held: list) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """The block of what is ``held``, which is emptied."""
    rows, doc, word = zip(*held, strict=True)
    held.clear()
    doc, word = np.concatenate(doc), np.concatenate(word)
    order = np.argsort(word, kind="stable")  # documents are in order
    doc, word = doc[order], word[order]
    del order
    new = _firsts(word, doc)
    return pa.Table.from_batches(rows), doc[new], word[new], np.diff(np.append(new, len(word)))


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where the values change, the first row included."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    change = [c[1:] != c[:-1] for c in columns]
    return np.flatnonzero(np.append(True, np.logical_or.reduce(change)))


def _count(batches):
    """In how many documents of each class and fold each word occurs; the null word is in all."""
    for rows, doc, word, _ in _blocks(batches):
        group = rows["toxic"].to_numpy() * 2 + rows["fold"].to_numpy()
        first = _firsts(word)
        of = group[doc]
        names = [pa.array(word[first].view(np.int64)), pa.array([None], pa.int64())]
        counts = [
            [pa.array(np.add.reduceat((of == g).astype(np.int64), first) if len(first) else first), pa.array([int((group == g).sum())])]
            for g in range(len(COUNTS))
        ]
        for i in range(2):
            yield pa.record_batch({"word": names[i]} | {n: c[i] for n, c in zip(COUNTS, counts, strict=True)})


def _beyond(ratio: float) -> float:
    return math.copysign(max(abs(ratio) - MARGIN, 0.0), ratio)


def make_weights(counts: DataFrame) -> tuple[DataFrame, dict[str, float]] | None:
    """(word and its weight in each model, that of unseen words in each model) from the counted words.
    A weight is the log-likelihood ratio, toxic over ordinary, beyond the margin. Models without a
    word in either class are left out; none at all without that of the whole."""
    documents = counts.filter("word IS NULL").first()
    if documents is None:
        return None
    words = counts.filter("word IS NOT NULL")
    docs = {m: [sum(documents[f"n{y}{f}"] for f in folds) for y in CLASSES] for m, folds in MODELS.items()}
    docs = {m: d for m, d in docs.items() if all(d)}
    n = {m: [sum((F.col(f"n{y}{f}") for f in MODELS[m]), F.lit(0)) for y in CLASSES] for m in docs}
    most = {m: [DISCOUNT * d / min(docs[m]) for d in docs[m]] for m in docs}
    sums = [F.count(F.lit(1)).alias("words")]
    for m in docs:
        sums.append(F.sum(n[m][0] + n[m][1]).alias(f"{m}_all"))
        for y in CLASSES:  # whole numbers: the same in any order
            few = n[m][y] <= most[m][y]
            sums += [F.sum(F.when(few, n[m][y])).alias(f"{m}_few{y}"), F.count(F.when(~few, 1)).alias(f"{m}_many{y}")]
    total = words.agg(*sums).first()
    weights, unseen = {}, {}
    for m in docs:
        taken = [(total[f"{m}_few{y}"] or 0) + total[f"{m}_many{y}"] * most[m][y] for y in CLASSES]
        if not all(taken):
            continue
        shared = (n[m][0] + n[m][1]) / total[f"{m}_all"]
        logs = [F.log((n[m][y] - F.least(n[m][y], F.lit(most[m][y]))) / docs[m][y] + taken[y] / docs[m][y] * shared) for y in CLASSES]
        ratio = logs[1] - logs[0]
        unseen[m] = _beyond(math.log(taken[1] / docs[m][1]) - math.log(taken[0] / docs[m][0]))
        beyond = F.signum(ratio) * F.greatest(F.abs(ratio) - MARGIN, F.lit(0.0))
        weights[m] = F.when(n[m][0] + n[m][1] > 0, beyond).otherwise(unseen[m])
    if "whole" not in weights:
        return None
    return words.select("word", *[w.alias(m) for m, w in weights.items()]), unseen


def _word_rows(batches):
    """For each block a row with the keys and lengths of its documents, and a row for each word."""
    task = TaskContext.get().partitionId()
    for i, (rows, doc, word, times) in enumerate(_blocks(batches)):
        block = task << 32 | i
        keys = rows["key"].combine_chunks()
        n = np.bincount(doc, weights=times, minlength=len(keys)).astype(np.int64)
        lists = [pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), x) for x in (keys, pa.array(n))]
        spread = k.mix(np.array([block], np.uint64)).view(np.int64)  # only deals the blocks out
        yield pa.record_batch(
            {"word": pa.array(spread), "block": pa.array([block]), "docs": pa.nulls(1, pa.binary()), "keys": lists[0], "lengths": lists[1]}
        )
        rows_of = -(-times // 255)  # a number above 255 is told in parts
        entries = np.empty(int(rows_of.sum()), ENTRY)
        entries["doc"] = np.repeat(doc, rows_of)
        entries["times"] = 255
        entries["times"][np.cumsum(rows_of) - 1] = times - 255 * (rows_of - 1)
        word = np.repeat(word, rows_of)
        del doc, times, rows_of
        first = _firsts(word)
        offsets = (np.append(first, len(word)) * ENTRY.itemsize).astype(np.int32)
        docs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(entries.tobytes())])
        for a in range(0, len(first), 1 << 16):
            own = first[a : a + (1 << 16)]
            yield pa.record_batch(
                {
                    "word": pa.array(word[own].view(np.int64)),
                    "block": pa.array(np.full(len(own), block)),
                    "docs": docs.slice(a, len(own)),
                    "keys": pa.nulls(len(own), lists[0].type),
                    "lengths": pa.nulls(len(own), lists[1].type),
                }
            )


def raw_scores(docs: DataFrame, weights: DataFrame, unseen: dict[str, float]) -> DataFrame:
    """``key`` and the length-normalised log-likelihood ratio of each model (a column of ``weights``)
    of every row of ``docs`` (key, text)."""
    kind = docs.schema["key"].dataType.simpleString()
    differs = None
    for m, u in unseen.items():
        differs = F.col(m) != u if differs is None else differs | (F.col(m) != u)
    known = weights.filter(differs).select("word", *unseen)
    rows = docs.select("key", "text").mapInArrow(_word_rows, f"word long, block long, docs binary, keys array<{kind}>, lengths array<bigint>")
    hit = F.col("keys").isNotNull() | F.col(next(iter(unseen))).isNotNull()
    names = list(unseen)

    def add(block: pa.Table) -> pa.Table:
        head = block.filter(block["keys"].is_valid())
        keys = head["keys"].combine_chunks().flatten()
        n = head["lengths"].combine_chunks().flatten().to_numpy()
        # in the order of the words, so that sums are alike in each run
        hits = block.filter(block["keys"].is_null()).sort_by("word")
        found = hits["docs"].cast(pa.large_binary()).combine_chunks()
        offsets = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
        entries = np.frombuffer(found.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view(ENTRY)
        of = np.repeat(np.arange(len(found)), np.diff(offsets) // ENTRY.itemsize)
        out = {"key": keys}
        for m in names:
            weight = hits[m].to_numpy().astype(float) - unseen[m]
            sums = np.bincount(entries["doc"], weights=entries["times"] * weight[of], minlength=len(keys))
            out[m] = pa.array((sums + unseen[m] * n) / np.sqrt(n + LENGTH_PRIOR))
        return pa.table(out)

    schema = f"key {kind}, " + ", ".join(f"{m} double" for m in names)
    return rows.join(known, "word", "left").filter(hit).groupBy("block").applyInArrow(add, schema)


class Scorer(NamedTuple):
    """A fitted classifier; no weights where there was nothing to learn from."""

    weights: DataFrame | None
    unseen: float
    slope: float
    intercept: float

    def scores(self, docs: DataFrame) -> DataFrame:
        """key and score of every row of ``docs`` (key, text)."""
        if self.weights is None:
            return docs.select("key", F.lit(0.0).alias("score"))
        z = self.slope * F.col("whole") + self.intercept
        z = F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))
        return raw_scores(docs, self.weights, {"whole": self.unseen}).select("key", (1 / (1 + F.exp(-z))).alias("score"))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps with a weak prior (so that separable rows converge)."""
    scale = max(float(np.abs(x).max(initial=0)), 1e-9)
    a = np.stack([x / scale, np.ones_like(x)], 1)
    beta = np.zeros(2)
    prior = np.diag([1e-3, 1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (y - p) - prior @ beta
        hess = (a * (p * (1 - p))[:, None]).T @ a + prior
        step = np.linalg.solve(hess, grad)
        beta += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no label is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Scorer:
    """Fit on the labelled documents (as given: leave out what is held out beforehand)."""
    spark = docs.sparkSession
    common.prepare(spark)
    told = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold")
    rows = common.texts(docs, id_col, text_col)
    known = rows.join(told.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "toxic", fold)
    sums = [F.sum(c).alias(c) for c in COUNTS]
    counted = known.select("text", "toxic", "fold").mapInArrow(_count, ", ".join(["word long", *[f"{c} long" for c in COUNTS]]))
    made = make_weights(common.stage(counted.groupBy("word").agg(*sums), "word-counts"))
    if made is None:
        return Scorer(None, 0.0, 0.0, 0.0)
    weights, unseen = common.stage(made[0], "word-weights"), made[1]
    # Rows of one half are scored by the other half's model (by the whole model where a half has
    # no row of some class).
    models = ["fold1", "fold0"] if len(unseen) == len(MODELS) else ["whole"] * 2
    # At most CALIBRATION_ROWS narrow rows: safe to broadcast.
    sample = told.orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS)
    sampled = rows.join(F.broadcast(sample), "doc_id").select((F.col("toxic") * 2 + fold).alias("key"), "text")
    rated = (
        raw_scores(sampled, weights, {m: unseen[m] for m in models})
        .select(F.when(F.col("key") % 2 == 0, F.col(models[0])).otherwise(F.col(models[1])).alias("raw"), F.expr("key div 2").alias("toxic"))
        .groupBy("raw", "toxic")
        .count()
        .toPandas()
        .sort_values(["raw", "toxic"])
    )
    x = np.repeat(rated["raw"].to_numpy(float), rated["count"])
    y = np.repeat(rated["toxic"].to_numpy(float), rated["count"])
    return Scorer(weights, unseen["whole"], *fit_logistic(x, y))


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every document."""
    common.prepare(docs.sparkSession)
    return scorer.scores(common.texts(docs, id_col, text_col, "key")).withColumnRenamed("key", "doc_id")


def drop_toxic(docs: DataFrame, scorer: Scorer, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score is below ``threshold``."""
    common.prepare(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    node = F.unhex(F.substring(F.sha2(text, 256), 1, 32))  # the score is one of the text alone
    rated = scorer.scores(docs.select(node.alias("key"), text.alias("text")))
    rejected = common.stage(rated.filter(F.col("score") >= threshold).select("key").distinct(), "rejected")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), node.alias("key"))
    return presence.without_keys(rows, rejected).select("row.*")
