"""Token counts with a digest cache.

A count depends only on the text and the tokenizer, so it is stored once for each pair of content
digest (SHA-256 of the text, null read as empty) and tokenizer version (SHA-256 of its file). A
run joins its distinct digests to the cache, encodes one text for each digest that is missing,
appends those counts, and joins all rows to the cache.

Only the missing texts move: their digests (after a partial aggregate, so a text that a third of
all rows share is one row) are the small side of a hash join with the documents. The cache is a
Parquet folder; a run only ever adds files to it, and rows that two runs added for one digest are
read as one. A failed run adds nothing.

Defined results: null and empty texts have no token; rows that repeat an id or a text are each
reported; a null id stays null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm import common
from cabflow.llm import kernels as k
from cabflow.llm.tokens import Encoder
from cabflow.session import scratch_dir

CACHE_SCHEMA = "version string, digest binary, n_tokens long"


def version_of(tokenizer_path: str) -> str:
    with open(tokenizer_path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _counter(tokenizer_path: str):
    def count(batches):
        encoder = Encoder.of(tokenizer_path)
        for c in k.chunks(batches):
            _, bounds = encoder.encode(c.data, c.bounds)
            yield pa.record_batch({"digest": c.rows.column("digest"), "n_tokens": pa.array(bounds[1:] - bounds[:-1])})

    return count


def read_cache(spark, cache_path: str, version: str) -> DataFrame:
    """Counts of one tokenizer version by digest (empty where the folder does not exist yet)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_path)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    else:
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens. ``cache_path`` is a shared folder that
    later runs may name again; without it the cache lives for this run below the checkpoint folder."""
    spark = docs.sparkSession
    common.prepare(spark)
    cache_path = cache_path or scratch_dir(spark, "token-cache")
    version = version_of(tokenizer_path)
    rows = common.texts(docs, id_col, text_col).select(
        common.key().alias("doc_id"), "text", F.unhex(F.sha2("text", 256)).alias("digest")
    )
    narrow = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    one = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    missing = one.join(read_cache(spark, cache_path, version), "digest", "left_anti")
    counted = (
        rows.join(missing.hint("shuffle_hash"), ["digest", "doc_id"])
        .select("digest", "text")
        .mapInArrow(_counter(tokenizer_path), "digest binary, n_tokens long")
        .dropDuplicates(["digest"])
    )
    counted.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache_path)
    return narrow.join(read_cache(spark, cache_path, version), "digest").select(
        common.unkey("doc_id").alias("doc_id"), "n_bytes", "n_tokens"
    )
