import random

import pytest
from pyspark.sql import functions as F

from cabflow.llm import common, presence


@pytest.mark.parametrize("most", [1 << 27, 1 << 10])
def test_rows_without_listed_keys(spark, most, monkeypatch):
    """The same rows as an anti join gives, also when the filter is far too small for the keys."""
    monkeypatch.setattr(presence, "MOST_BITS", most)
    rnd = random.Random(most)
    rows = [(rnd.randrange(3000).to_bytes(4, "big"), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "key binary, i long").repartition(5)
    listed = {rnd.randrange(3000).to_bytes(4, "big") for _ in range(900)} | {b"", b"other"}
    keys = common.stage(spark.createDataFrame([(k,) for k in listed] * 2, "key binary"), "keys")
    out = presence.without_keys(df, keys)
    assert out.columns == df.columns
    assert sorted(r.i for r in out.collect()) == [i for k, i in rows if k not in listed]


def test_nothing_listed_and_no_rows(spark):
    df = spark.range(10).select(F.col("id").cast("string").cast("binary").alias("key"), "id")
    none = common.stage(df.limit(0).select("key"), "keys")
    assert presence.without_keys(df, none).count() == 10
    every = common.stage(df.select("key"), "keys")
    assert presence.without_keys(df, every).collect() == [] and presence.without_keys(df.limit(0), every).collect() == []
