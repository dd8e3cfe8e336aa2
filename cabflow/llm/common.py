"""Spark helpers the operators share: selecting the needed columns, staging, batch sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.session import remove_path, scratch_dir

#: Key of rows whose id is null (so that joins on the key keep them).
NULL_ID = -(2**63)


def prepare(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch: texts are long, and a batch is held whole in a task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", id_name: str = "doc_id") -> DataFrame:
    """The key and the text alone; a null text counts as empty. Other columns are not read."""
    return docs.select(
        F.col(id_col).cast("long").alias(id_name),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def key(col: str = "doc_id") -> Column:
    """The id as a join key that is never null."""
    return F.coalesce(F.col(col), F.lit(NULL_ID))


def unkey(col: str) -> Column:
    return F.when(F.col(col) != NULL_ID, F.col(col))


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts the lineage, so a
    lost executor costs a re-read, and later steps do not repeat the work before."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def drop(*staged: DataFrame) -> None:
    """Delete tables from ``stage`` that nothing will read again (the rest goes when the driver ends)."""
    for df in staged:
        remove_path(df.sparkSession, df.staged_at)
