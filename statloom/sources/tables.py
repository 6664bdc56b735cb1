"""Tables in: SQL over named tables, parquet, literal rows, schema text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import col
from statloom.functions.linetext import CSV_OPTIONS, many_lines

_ARROW = {"long": pa.int64(), "integer": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "boolean": pa.bool_()}


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[col(c) for c in columns]) if columns else df


def read_csv(spark: SparkSession, path: str, schema, header: bool = True) -> DataFrame:
    """CSV as ``save_csv`` writes it, with a declared schema: no extra pass to infer one."""
    return many_lines(spark.read.schema(schema).options(**CSV_OPTIONS).option("header", header).csv(path))


def read_source(spark: SparkSession, kind: str, **options: str) -> DataFrame:
    """Any source Spark knows by name, with the options of its connector (``path`` among them)."""
    return spark.read.format(kind).options(**options).load()


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make frames addressable by name in SQL text."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def query(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL. Registered tables go by their name; frames given here go by ``{name}``."""
    return spark.sql(text, **frames)


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Driver-side rows as a table. It becomes a local relation of the plan: no tasks run to hold it."""
    kind = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(kind)
    arrays = {f.name: pa.array(values, _ARROW[f.dataType.typeName()]) for f, values in zip(kind.fields, columns)}
    return spark.createDataFrame(pa.table(arrays), kind)


def zipped(spark: SparkSession, first: Sequence, second: Sequence, schema: str) -> DataFrame:
    """Two parallel driver-side lists as a two-column table."""
    if len(first) != len(second):
        raise ValueError(f"lists of {len(first)} and {len(second)} values do not pair up")
    return literal_rows(spark, zip(first, second), schema)


def schema_ddl(df: DataFrame) -> str:
    """Column list for a CREATE TABLE statement."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as a table: ``position, name, type, nullable``."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return literal_rows(df.sparkSession, rows, "position int, name string, type string, nullable boolean")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))
