"""Leaving rows where they are when a join would drop few of them.

An anti join of whole documents with a long list of keys shuffles every text. Here the keys are first put in a Bloom
filter of bounded size; rows that it does not know are certainly not listed and pass without a shuffle, and
only the others, the listed ones and a few more, go through the exact join. When there are more keys than the
filter takes, more rows go through the join; the result is the same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: as many as wanted for each key, and at most (16 MB, whatever the number of keys).
BITS_PER_KEY, MOST_BITS = 16, 1 << 27
HASHES = 3


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def _filter_of(keys: DataFrame) -> tuple[np.ndarray, int]:
    """(words of the filter, its bits) over the column ``key`` of a staged table."""
    n = keys.count()
    bits = min(MOST_BITS, 1 << max(10, (n * BITS_PER_KEY - 1).bit_length()))
    at = F.explode(F.array(*_places(F.col("key"), bits))).alias("at")
    one = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    rows = keys.select(at).select(F.shiftright("at", 6).alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = rows.toPandas()  # at most MOST_BITS / 64 rows
    words = np.zeros(max(1, bits // 64), np.uint64)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return words, bits


def without_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` (with a column ``key``, never null) whose key is not in the staged table ``keys``."""
    words, bits = _filter_of(keys)

    @F.pandas_udf("boolean")
    def may_be_listed(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        known = np.ones(len(a), bool)
        for at in (a, b, c):
            at = at.to_numpy(np.uint64)
            known &= (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return pd.Series(known)

    told = rows.withColumn("__listed", may_be_listed(*_places(F.col("key"), bits)))
    sure = told.filter(~F.col("__listed")).drop("__listed")
    asked = told.filter(F.col("__listed")).drop("__listed")
    return sure.unionByName(asked.join(keys.select("key").distinct(), "key", "left_anti").select(*rows.columns))
