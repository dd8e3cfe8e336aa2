"""Token ids as Parquet: a list column, written in id order, with selective reads in mind.

Rows are range-partitioned by id, so a file holds a run of ids in ascending order. Each row has
the place of its first id within its file; the number of ids of a whole file is a sum over one
narrow column, so the place in the whole corpus needs a running sum over files only, never a
pass of all rows through one task. The ids are dictionary-encoded (a vocabulary fits a dictionary
page), the ascending numbers delta-encoded; row groups are small and page indexes are on, so
that a reader of some documents or of the counts alone skips the rest.

Defined results: a null or empty text is the end id alone; rows that repeat an id are ordered
by text hash, each with its own place; a null id sorts first and stays null; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabflow.llm import common
from cabflow.llm import kernels as k
from cabflow.llm.tokens import Encoder

FILE_SCHEMA = "part int, doc_id long, at long, n_tokens int, ids array<int>"
#: Writer settings of the files.
WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a chunk's documents with ``end_id`` after each document."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


def _encoder(tokenizer_path: str, end_id: int):
    def encode(batches):
        encoder, part, at = Encoder.of(tokenizer_path), TaskContext.get().partitionId(), 0
        for c in k.chunks(batches):
            ids, bounds = with_end(*encoder.encode(c.data, c.bounds), end_id)
            n = c.rows.num_rows
            yield pa.record_batch(
                {
                    "part": pa.array(np.full(n, part, np.int32)),
                    "doc_id": c.rows.column("doc_id"),
                    "at": pa.array(at + bounds[:-1]),
                    "n_tokens": pa.array(np.diff(bounds).astype(np.int32)),
                    "ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32))),
                }
            )
            at += int(bounds[-1])

    return encode


def write_token_ids(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text and write the files to ``path`` in ascending id order."""
    spark = docs.sparkSession
    common.prepare(spark)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (
        common.texts(docs, id_col, text_col)
        .repartitionByRange(common.width(spark), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_encoder(tokenizer_path, end_id), FILE_SCHEMA)
        .write.options(**WRITER)
        .parquet(path)
    )


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids. Columns that a query does
    not use are not read."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    # One row per file: bounded by the number of write tasks, not by the documents.
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids"
    )


def crc_of_lists(ids: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of each list's ids as little-endian unsigned 32-bit integers."""
    flat = np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False), dtype="<u4").view(np.uint8)
    off = ids.offsets.to_numpy().astype(np.int64)
    off = (off - off[0]) * 4
    return pa.array([zlib.crc32(flat[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.int64())


def add_crc(rows: DataFrame, column: str = "ids", name: str = "ids_crc32") -> DataFrame:
    """``rows`` with the list column replaced by its checksum."""
    keep = [f for f in rows.schema.fields if f.name != column]

    def crc(batches):
        for b in batches:
            cols = {f.name: b.column(b.schema.get_field_index(f.name)) for f in keep}
            yield pa.record_batch(cols | {name: crc_of_lists(b.column(b.schema.get_field_index(column)))})

    return rows.mapInArrow(crc, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), f"{name} long"]))
