"""Binding CSV columns by the names in each file's header.

The plain reader binds by position: a file whose columns stand in another order is read without an error and with its
values in the wrong columns. Here the header of every file is read first (one line each, through the file system of
the path, compressed or not), files are grouped by header, each group is read with the schema in *its* order, and the
columns are put back into the order of the schema. Names are compared without case and surrounding blanks.

A header with an unknown, a missing or a repeated name raises ``ValueError`` with the file's name; nothing is read then.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cabflow.sources import malformed


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a read of ``path`` (file, directory or glob) takes: hidden ones are left out."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, left = [], list(fs.globStatus(p) or [])
    while left:
        status = left.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            left += [s for s in fs.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
        elif not name.startswith(("_", ".")) and status.getLen():
            found.append(status.getPath().toString())
    if not found:
        raise FileNotFoundError(f"no file matches {path}")
    return sorted(found)


def header_of(spark: SparkSession, file: str) -> list[str]:
    """The names in the first line of one file."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        line = jvm.java.io.BufferedReader(text).readLine() or ""
    finally:
        stream.close()
    return [name.strip() for name in next(csv.reader([line.removeprefix("\ufeff")]), [])]


def order_of(names: Sequence[str], schema: StructType, file: str) -> tuple[str, ...]:
    """The schema's names in the order of a header."""
    wanted = {n.lower(): n for n in schema.names}
    found = [n.lower() for n in names]
    unknown = [n for n, low in zip(names, found, strict=True) if low not in wanted]
    missing = [n for low, n in wanted.items() if low not in found]
    repeated = sorted({n for n in found if found.count(n) > 1})
    if unknown or missing or repeated:
        raise ValueError(f"{file}: unknown columns {unknown}, missing {missing}, repeated {repeated}")
    return tuple(wanted[low] for low in found)


def grouped_files(spark: SparkSession, schema: StructType, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of ``path`` by the order of their columns."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in data_files(spark, path):
        groups.setdefault(order_of(header_of(spark, file), schema, file), []).append(file)
    return groups


def read_by_name(spark: SparkSession, schema: StructType, path: str, keep_raw_line: bool = False) -> DataFrame:
    """The feed with its columns bound by name. With ``keep_raw_line``, every group of files also has the raw line of
    its malformed rows (``malformed.MALFORMED``); their faults are judged in the order of the schema, so the line
    is rewritten to that order."""
    out = None
    for order, files in grouped_files(spark, schema, path).items():
        own = StructType([schema[n] for n in order])
        part = malformed.read_checked(spark, own, files)
        if keep_raw_line:
            part = part.withColumn(malformed.MALFORMED, malformed.reordered(own, schema))
            part = part.select(*schema.names, malformed.MALFORMED)
        else:
            part = part.select(*schema.names)
        out = part if out is None else out.unionByName(part)
    return out


def written_as(file: str) -> str:
    """The file that a part belongs to: a job writes ``trips.csv`` as a folder of that name with files ``part-*``."""
    folder, _, name = file.rpartition("/")
    return folder if name.startswith("part-") else file


def header_rows(spark: SparkSession, schema: StructType, path: str, parts: bool = False) -> DataFrame:
    """What the check finds: ``position, name, type, place, files`` — each column of the schema, with its place in the
    header and the number of files that have it there. With ``parts``, files that one job wrote into a folder (the
    header of each is read) are one file; if their headers differ, it counts once for each."""
    rows = [
        (i, f.name, f.dataType.simpleString(), order.index(f.name), len({written_as(x) if parts else x for x in files}))
        for order, files in grouped_files(spark, schema, path).items()
        for i, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(rows, "position int, name string, type string, place int, files int")
