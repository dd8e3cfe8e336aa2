"""Source divergence audit: how far the sources of a language differ in their terms, over a quadtree.

Terms are runs of letters (lower-cased A-Z); a language keeps those in at least ``MIN_DOCS`` of its documents.
A group is a (language, source). Every group and every language gives each kept term a smoothed share p, and
two shares differ by f = (p - q)^2 / (p + q), all in integers. The audit has, per group, the sum of f over
all kept terms to every other source of its language (``pair``) and its terms that stand out most against the
language (``term``).

The counts are a matrix of groups by terms, nearly empty for most sources. It is cut into tiles of at
most about ``TILE_GROUPS`` rows and ``TILE_TERMS`` columns. Each tile is a K^2 tree with K = 2: square quadrants, each
halved both ways, with one bit that says whether it holds any count (``quadrants``). Two row ranges are
walked down jointly, for all group pairs in them at once: where the quadrants of both are empty, every
term there has the same f for a pair, and only the number of terms is noted (it is priced once, at
the end, by the shares that the groups give to an absent term); else the walk goes on to the
quarters, down to single cells (``walk``). It goes in portions of bounded size.

So a task holds two tiles, whatever the number of documents, terms or sources; what the tiles of all term ranges
say of a pair is then summed. The texts are read once; counts are summed in the task before they are sent.

Defined results: a null text, lang or source counts as empty; a language without kept terms has distance 0 in all
pairs and no ``term`` rows; rows that repeat an id are documents of their own; ids are not read; an empty table
gives no rows; other columns are not read. Names and terms are ordered by their UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabflow.llm import common
from cabflow.llm import kernels as k

MIN_DOCS, TOP_TERMS = 10, 10
TILE_GROUPS, TILE_TERMS = 256, 8192
#: Quadrant pairs that a step of the walk expands at once; rows after which counts are merged and sent.
PORTION, HELD_ROWS = 1 << 16, 400_000
SHARES = 1_000_000_000
# Bytes of a term after lower-casing A-Z, `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`.
LETTERS = k.ALNUM.copy()
LETTERS[0x30:0x3A] = False
COUNTS = "lang string, source string, term string, n long, df long"
TILE = "lang string, kind string, g int, h int, term string, value long"
_TILE = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("g", pa.int32()), ("h", pa.int32()), ("term", pa.string()), ("value", pa.int64())])


def count_terms(c: k.Chunk) -> pa.Table:
    """COUNTS of one chunk: occurrences of each term, and documents that have it, by language and source."""
    lower = k.LOWER[c.data]
    w = k.words(lower, c.bounds, LETTERS)
    names = pa.Table.from_batches([c.rows]).select(["lang", "source"]).combine_chunks()
    groups = names.group_by(["lang", "source"]).aggregate([])
    at = {x: i for i, x in enumerate(zip(groups["lang"].to_pylist(), groups["source"].to_pylist(), strict=True))}
    group = np.array([at[x] for x in zip(names["lang"].to_pylist(), names["source"].to_pylist(), strict=True)], np.int64)
    _, first, term = np.unique(w.hash, return_index=True, return_inverse=True)
    pair, n = np.unique(w.doc() * max(1, len(first)) + term, return_counts=True)  # (document, term)
    doc, term = np.divmod(pair, max(1, len(first)))
    cell, which = np.unique(group[doc] * max(1, len(first)) + term, return_inverse=True)
    own, term = np.divmod(cell, max(1, len(first)))
    raw = lower.tobytes()
    words = pa.array([raw[a:b] for a, b in zip(w.start[first].tolist(), w.end[first].tolist(), strict=True)], pa.binary())
    return pa.table(
        {
            "lang": groups["lang"].take(pa.array(own)).cast(pa.string()),
            "source": groups["source"].take(pa.array(own)).cast(pa.string()),
            "term": words.cast(pa.string()).take(pa.array(term)),
            "n": np.bincount(which, n, len(cell)).astype(np.int64),
            "df": np.bincount(which, minlength=len(cell)).astype(np.int64),
        }
    )


def _counter(batches) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        t = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("df", "sum")])
        return t.rename_columns([x.removesuffix("_sum") for x in t.column_names]).select(["lang", "source", "term", "n", "df"])

    for c in k.chunks(batches):
        held.append(count_terms(c))
        if sum(t.num_rows for t in held) >= HELD_ROWS:
            yield from merged().to_batches(max_chunksize=10_000)
            held = []
    if held:
        yield from merged().to_batches(max_chunksize=10_000)


def share(count: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """1 + floor(SHARES * (count + 2) / (total + 2 * kept)), by long division (exact below 9 * 10^15)."""
    whole = np.asarray(total, np.int64) + 2 * kept
    out, left = np.divmod(np.asarray(count, np.int64) + 2, whole)
    for _ in range(3):
        digit, left = np.divmod(left * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def quadrants(filled: np.ndarray, levels: int) -> list[np.ndarray]:
    """The bits of a K^2 tree (K = 2) from its cells up: level l has one bit for every square of 2^l cells."""
    side = 1 << levels
    padded = np.zeros([-(-n // side) * side for n in filled.shape], bool)
    padded[: filled.shape[0], : filled.shape[1]] = filled
    out = [padded]
    for _ in range(levels):
        x = out[-1]
        out.append(x[::2, ::2] | x[1::2, ::2] | x[::2, 1::2] | x[1::2, 1::2])
    return out


def walk(a: list[np.ndarray], b: list[np.ndarray], shape: tuple[int, int, int], same: bool):
    """Walk two trees jointly, for all pairs of a row of ``a`` and a row of ``b`` (``same``: of one tree, the
    second row below the first). ``shape``: rows of a, rows of b, terms. Yields ("empty", row, row, number of
    terms, level): quadrants empty in both; and ("cell", rows, rows, terms, 0): cells that one of them has."""
    rows_a, rows_b, terms = shape
    top = len(a) - 1
    i, j, t = (x.ravel() for x in np.meshgrid(*[np.arange(n) for n in (a[top].shape[0], b[top].shape[0], a[top].shape[1])], indexing="ij"))
    left = [(top, i, j, t)]
    while left:
        level, i, j, t = left.pop()
        if len(i) > PORTION:
            left += [(level, i[x : x + PORTION], j[x : x + PORTION], t[x : x + PORTION]) for x in range(0, len(i), PORTION)]
            continue
        inside = (i << level < rows_a) & (j << level < rows_b) & (t << level < terms)
        if same:
            inside &= (i < j) | ((i == j) & (level > 0))
        i, j, t = i[inside], j[inside], t[inside]
        filled = a[level][i, t] | b[level][j, t]
        none = ~filled
        if none.any():
            start = t[none] << level
            yield "empty", i[none], j[none], np.minimum(terms, start + (1 << level)) - start, level
        i, j, t = i[filled], j[filled], t[filled]
        if not len(i):
            continue
        if level == 0:
            yield "cell", i, j, t, 0
        else:
            for x in range(8):
                left.append((level - 1, 2 * i + (x >> 2), 2 * j + (x >> 1 & 1), 2 * t + (x & 1)))


def pair_sums(p, q, zero_p, zero_q, same: bool) -> np.ndarray:
    """(row of the one tile, row of the other): sum of f over the terms. ``p``, ``q``: shares of the cells
    (0: no count); ``zero_p``, ``zero_q``: of each row, its share of a term it has not."""
    (rows_a, terms), rows_b = p.shape, q.shape[0]
    levels = max(0, int(max(rows_a, rows_b) - 1).bit_length())
    a = quadrants(p > 0, levels)
    b = a if same else quadrants(q > 0, levels)
    side = 1 << levels
    empty = [np.zeros((-(-rows_a // side) << (levels - n), -(-rows_b // side) << (levels - n)), np.int64) for n in range(levels + 1)]
    total = np.zeros((rows_a, rows_b), np.int64)
    for what, i, j, t, level in walk(a, b, (rows_a, rows_b, terms), same):
        if what == "empty":
            np.add.at(empty[level], (i, j), t)
        else:
            x, y = p[i, t], q[j, t]
            np.add.at(total, (i, j), differ(np.where(x > 0, x, zero_p[i]), np.where(y > 0, y, zero_q[j])))
    for level in range(levels, 0, -1):  # what is empty for a range of rows is so for each
        empty[level - 1] += empty[level].repeat(2, 0).repeat(2, 1)
    return total + empty[0][:rows_a, :rows_b] * differ(zero_p[:, None], zero_q[None, :])


def _audit(tile: pa.Table, top: int) -> pa.Table:
    """TILE rows of two tiles of one term range: sums of pairs g < h, and the best terms of each group."""
    lang, bi, bj = (tile[n][0].as_py() for n in ("lang", "bi", "bj"))
    is_group = tile["term"].is_null().to_numpy()
    gid, block, n = (tile[x].to_numpy() for x in ("gid", "block", "n"))
    head = tile.filter(tile["term"].is_null()).slice(0, 1)
    kept, all_terms, in_range = (head[x][0].as_py() for x in ("kept", "all_terms", "total"))
    cells = tile.filter(tile["term"].is_valid())
    coded = cells["term"].combine_chunks()
    coded = (coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
    column, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    terms = len(words)

    def side(b):
        own = np.flatnonzero(is_group & (block == b))
        own = own[np.argsort(gid[own])]
        ids, totals = gid[own], n[own]
        at = np.flatnonzero(block[~is_group] == b)
        row = np.searchsorted(ids, gid[~is_group][at])
        p = np.zeros((len(ids), terms), np.int64)
        p[row, column[at]] = share(n[~is_group][at], totals[row], kept)
        zero = share(np.zeros(len(ids)), totals, kept) if kept else np.ones(len(ids), np.int64)
        return ids, at, row, p, zero

    ids, at, row, p, zero = side(bi)
    same = bi == bj
    ids_2, _, _, p_2, zero_2 = (ids, at, row, p, zero) if same else side(bj)
    sums = pair_sums(p, p_2, zero, zero_2, same) if terms else np.zeros((len(ids), len(ids_2)), np.int64)
    sums += (in_range - terms) * differ(zero[:, None], zero_2[None, :])  # terms that none of these rows has
    x, y = np.nonzero(np.triu(np.ones_like(sums, bool), 1)) if same else (np.indices(sums.shape).reshape(2, -1))
    g, h = ids[x], ids_2[y]
    out = [
        pa.table([pa.array([lang] * len(g), pa.string()), pa.array(["pair"] * len(g), pa.string()), pa.array(np.minimum(g, h), pa.int32()),
                  pa.array(np.maximum(g, h), pa.int32()), pa.nulls(len(g), pa.string()), pa.array(sums[x, y])], schema=_TILE)
    ]
    if same and terms:
        col = column[at]
        every = np.zeros(terms, np.int64)
        every[column] = cells["total"].to_numpy()
        q = share(every[col], all_terms, kept)
        own = p[row, col]
        up = own > q
        row, col, value = row[up], col[up], differ(own[up], q[up])
        rank_of = np.empty(terms, np.int64)
        rank_of[np.argsort(np.array([w.as_py().encode() for w in words], object), kind="stable")] = np.arange(terms)
        order = np.lexsort((rank_of[col], -value, row))
        row, col, value = row[order], col[order], value[order]
        new = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
        place = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row))))
        best = place < top
        row, col, value = row[best], col[best], value[best]
        m = len(row)
        out.append(
            pa.table([pa.array([lang] * m, pa.string()), pa.array(["term"] * m, pa.string()), pa.array(ids[row], pa.int32()),
                      pa.nulls(m, pa.int32()), words.take(pa.array(col)).cast(pa.string()), pa.array(value)], schema=_TILE)
        )
    return pa.concat_tables(out)


def _numbered(rows: DataFrame, cells: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per group: its number ``gid`` in its language, the block of rows it is in, how many ``blocks`` and
    ``tiles`` the language has, its sum ``n`` of counts, and the language's ``kept`` terms and ``all_terms``."""
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("all_terms"))
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(by_lang, "lang", "left")
    groups = groups.fillna(0, ["n", "kept", "all_terms"])
    lang = Window.partitionBy("lang")
    gid = F.row_number().over(lang.orderBy("source")) - 1
    return groups.select(
        "*",
        gid.alias("gid"),
        F.floor(gid / TILE_GROUPS).cast("int").alias("block"),
        F.ceil(F.count(F.lit(1)).over(lang) / TILE_GROUPS).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("kept") / TILE_TERMS)).cast("int").alias("tiles"),
    )


def _ranked(parts: DataFrame, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = parts.withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.filter(F.col("rank") <= top)


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: the other sources of the language with their distance,
    all ranks. Part ``term``: the group's terms above the language's share, to rank ``top``."""
    common.prepare(docs.sparkSession)
    columns = (("lang", lang_col), ("source", source_col), ("text", text_col))
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for name, c in columns])
    counts = rows.mapInArrow(_counter, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    counts = common.stage(counts, "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("total")).filter(F.col("df") >= min_docs)
    kept = common.stage(kept.drop("df"), "kept-terms")
    cells = common.stage(counts.drop("df").join(kept, ["lang", "term"]), "kept-counts")
    groups = common.stage(_numbered(rows, cells, kept), "groups")

    tiles = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")
    column = F.pmod(F.xxhash64("term"), F.col("tiles")).cast("int").alias("tile")
    same = ["lang", "gid", "block", "blocks", "kept", "all_terms"]
    tiled = kept.join(groups.select("lang", "tiles").distinct(), "lang").select("lang", column)
    lines = groups.select(*same, tiles, F.lit(None).cast("string").alias("term"), "n")
    lines = lines.join(tiled.groupBy("lang", "tile").agg(F.count(F.lit(1)).alias("total")), ["lang", "tile"], "left").fillna(0, ["total"])
    marks = cells.join(groups.drop("n"), ["lang", "source"]).select(*same, column, "term", "n", "total")
    items = (
        lines.unionByName(marks)
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"))
        .select("*", F.least("block", "x").alias("bi"), F.greatest("block", "x").alias("bj"))
        .drop("x", "blocks")
    )
    found = common.stage(items.groupBy("lang", "tile", "bi", "bj").applyInArrow(lambda t: _audit(t, top), TILE), "tile-audits")

    name = groups.select("lang", "gid", "source")
    sums = found.filter("kind = 'pair'").groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("g").alias("a"), F.col("h").alias("b")), F.struct(F.col("h").alias("a"), F.col("g").alias("b"))))
    pairs = (
        sums.select("lang", "value", both.alias("p"))
        .select("lang", "value", "p.a", "p.b")
        .join(name.toDF("lang", "a", "source"), ["lang", "a"])
        .join(name.toDF("lang", "b", "item"), ["lang", "b"])
        .select("lang", "source", "item", "value")
    )
    terms = found.filter("kind = 'term'").select("lang", F.col("g").alias("gid"), F.col("term").alias("item"), "value")
    terms = terms.join(name, ["lang", "gid"]).select("lang", "source", "item", "value")
    parts = [("pair", _ranked(pairs)), ("term", _ranked(terms, top))]
    one, two = (df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, df in parts)
    return one.unionByName(two)
