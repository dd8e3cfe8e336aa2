"""Malformed rows of the raw CSV feeds: what the permissive reader turns into NULL, counted and kept.

The reader sets a cell that does not parse to NULL, and fills short rows with NULLs, without a word. With the raw line
kept beside the parsed columns (``MALFORMED``; NULL for a clean row) every such row can be told why it is malformed:

* ``short_row`` / ``long_row``: fewer or more cells than the schema has (counted outside quotes);
* ``bad_<column>``: the cell has text, but its typed value is NULL (judged in rows of the right width only, as the
  cells of others may be misplaced).

The parsed values are those of the plain reader. Only malformed lines are parsed a second time, as text. The counts are
``observe()``d on the pass that reads the feed anyway; the rows themselves are written by another scan, run only if there
are any.

Defined results: an empty cell is a NULL, not a fault; a row can have several faults and counts once in ``malformed_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MALFORMED = "_malformed"
FAULTS = "faults"
ROWS = "malformed_rows"


def with_raw_line(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(MALFORMED, StringType(), True)])


def read_checked(spark: SparkSession, schema: StructType, path: str | list[str], header: bool = True) -> DataFrame:
    """The feed by position, as the plain reader gives it, with the raw line of each malformed row in ``MALFORMED``.
    Every line is parsed whole: a reader that parses only the wanted columns would not see what is wrong in others."""
    return (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)
        .schema(with_raw_line(schema))
        .csv(path)
    )


def is_checked(df: DataFrame) -> bool:
    return MALFORMED in df.columns


def cells_in(line: Column) -> Column:
    """Cells of a CSV line: commas outside quotes, and one."""
    return F.size(F.split(F.regexp_replace(line, r'"(?:[^"\\]|\\.|"")*"', ""), ",", -1))


def fault_conditions(schema: StructType) -> dict[str, Column]:
    """Name -> condition of each fault. ``schema``: the columns in the order of the file."""
    line, width = F.col(MALFORMED), len(schema.fields)
    cells = F.from_csv(line, ", ".join(f"c{i} string" for i in range(width)), {"mode": "PERMISSIVE"})
    n_cells = cells_in(line)
    out = {"short_row": n_cells < width, "long_row": n_cells > width}
    for i, f in enumerate(schema.fields):
        if not isinstance(f.dataType, StringType):
            out[f"bad_{f.name}"] = (n_cells == width) & cells[f"c{i}"].isNotNull() & F.col(f.name).isNull()
    return {name: F.coalesce(line.isNotNull() & c, F.lit(False)) for name, c in out.items()}


def with_faults(checked: DataFrame, schema: StructType) -> DataFrame:
    """The malformed rows: parsed columns, the raw line, and the names of their faults."""
    names = [F.when(c, F.lit(n)) for n, c in fault_conditions(schema).items()]
    return checked.filter(F.col(MALFORMED).isNotNull()).withColumn(FAULTS, F.array_compact(F.array(*names)))


def quarantine(checked: DataFrame, schema: StructType) -> DataFrame:
    """The malformed rows in a form that CSV can hold."""
    return with_faults(checked, schema).withColumn(FAULTS, F.array_join(FAULTS, "|"))


def _metrics(schema: StructType) -> list[Column]:
    rows = F.count_if(F.col(MALFORMED).isNotNull()).cast("bigint").alias(ROWS)
    return [rows, *[F.count_if(c).cast("bigint").alias(n) for n, c in fault_conditions(schema).items()]]


def observe_faults(checked: DataFrame, schema: StructType, name: str) -> tuple[DataFrame, Observation]:
    """(the feed without the raw line, its counts once an action has run)."""
    seen = Observation(f"{name}-malformed")
    return checked.observe(seen, *_metrics(schema)).drop(MALFORMED), seen


def faults_from_observation(spark: SparkSession, seen: Observation, source: str) -> DataFrame:
    """``source, metric, value``: malformed rows, and each fault that occurs."""
    rows = [(source, k, int(v)) for k, v in seen.get.items() if v or k == ROWS]
    return spark.createDataFrame(rows, "source string, metric string, value bigint")


def fault_counts(checked: DataFrame, schema: StructType, source: str) -> DataFrame:
    """The same table by an aggregate of its own."""
    one = checked.agg(*_metrics(schema))
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in one.columns])
    long = one.select(F.lit(source).alias("source"), F.explode(pairs).alias("m")).select("source", "m.metric", "m.value")
    return long.filter((F.col("value") > 0) | (F.col("metric") == ROWS))


def reordered(own: StructType, schema: StructType) -> Column:
    """The raw line of a malformed row with its cells in the order of ``schema``; lines of another width are kept as
    they are, as their cells cannot be told apart from misplaced ones."""
    line, width = F.col(MALFORMED), len(own.fields)
    if own.names == schema.names:
        return line
    cells = F.from_csv(line, ", ".join(f"c{i} string" for i in range(width)), {"mode": "PERMISSIVE"})
    ordered = F.to_csv(F.struct(*[cells[f"c{own.names.index(n)}"].alias(n) for n in schema.names]))
    return F.when(cells_in(line) == width, ordered).otherwise(line)
