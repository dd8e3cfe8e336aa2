"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

``find_copies`` reports a digest of every row, so it reads the text once into a narrow staged table
(id, byte length, prefix hash, SHA-256). ``drop_copies`` stages length and prefix hash alone, and
takes the digest only of rows that share both with another row, once. Each level groups only the rows that the level before could not tell
apart: a length that occurs once ends there, then a prefix hash that occurs once, and only what
is left is grouped by its full digest. Every grouping is a partial aggregate, so a text that
makes up a third of all rows collapses before the shuffle; the joins back are plain equi-joins
that adaptive execution splits where a key is hot.

Defined results: a null text counts as empty, and equal empty texts are copies like any other.
A null id sorts below every id. Rows that repeat both id and text form one group, of which one
row stays in ``drop_copies`` (in ``find_copies`` each of them is reported, with the same answer).
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm import common

PREFIX_CHARS = 256
LEVELS = (["n_bytes"], ["n_bytes", "prefix_hash"], ["n_bytes", "prefix_hash", "text_sha256"])


def _measures(text) -> list[F.Column]:
    return [F.octet_length(text).cast("long").alias("n_bytes"), F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix_hash")]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    d = common.texts(docs, id_col, text_col)
    return d.select(common.key("doc_id").alias("doc_id"), *_measures("text"), F.sha2("text", 256).alias("text_sha256"))


def copy_groups(prints: DataFrame, keep: str = "max") -> DataFrame:
    """One row for each text that occurs more than once: ``keep_id``, ``group_size`` and
    ``keep_rows``, the number of rows that carry the id that stays."""
    left = prints
    for cols in LEVELS[:-1]:
        many = left.groupBy(cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(cols)
        left = left.join(many, cols, "left_semi")
    by = LEVELS[-1]
    pick = F.max if keep == "max" else F.min
    per_id = left.groupBy(*by, "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    return (
        per_id.groupBy(by)
        .agg(pick(F.struct("doc_id", "rows")).alias("k"), F.sum("rows").alias("group_size"))
        .filter("group_size > 1")
        .select(*by, F.col("k.doc_id").alias("keep_id"), F.col("k.rows").alias("keep_rows"), "group_size")
    )


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """One row per document: doc_id, n_bytes, text_sha256, keep_id (the id that stays of its group;
    largest by default), group_size and kept."""
    prints = common.stage(fingerprints(docs, id_col, text_col), "exact-prints")
    joined = prints.join(copy_groups(prints, keep), LEVELS[-1], "left")
    keep_id = F.coalesce("keep_id", "doc_id")
    return joined.select(
        common.unkey("doc_id").alias("doc_id"),
        "n_bytes",
        F.when(keep_id != common.NULL_ID, keep_id).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (keep_id == F.col("doc_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The documents, all columns, with one row of each group of equal texts."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    alike = common.stage(docs.select(*_measures(text)), "exact-prints")
    for cols in LEVELS[:-1]:
        many = alike.groupBy(cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(cols)
        alike = alike.join(many, cols, "left_semi")
    many = common.stage(many, "exact-alike")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    doc_id = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(common.NULL_ID)).alias("doc_id")
    every = docs.select(row.alias("row"), doc_id, *_measures(text))
    alone = every.join(many, LEVELS[1], "left_anti").select("row.*")
    left = every.join(many, LEVELS[1], "left_semi")
    digest = F.sha2(F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")), 256).alias("text_sha256")
    rows = common.stage(left.select("row", "doc_id", *LEVELS[1], digest), "exact-digests")
    groups = common.stage(copy_groups(rows.drop("row"), keep), "exact-groups")
    joined = rows.join(groups, LEVELS[-1], "left").filter("keep_id IS NULL OR keep_id = doc_id")
    once = alone.unionByName(joined.filter("keep_rows IS NULL OR keep_rows = 1").select("row.*"))
    if groups.filter("keep_rows > 1").isEmpty():
        return once
    # The same id and text more than once: such rows (only these) are collapsed to one.
    again = joined.filter("keep_rows > 1").dropDuplicates(["doc_id", "text_sha256"]).select("row.*")
    return once.unionByName(again)
