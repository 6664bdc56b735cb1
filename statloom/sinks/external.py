"""Publishing a table as delimited text that other engines can read: see ``functions/linetext.py`` for its form."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from statloom.functions.columns import col
from statloom.functions.linetext import CSV_OPTIONS, ESCAPES, one_line
from statloom.sources.tables import schema_ddl

def publishable(df: DataFrame, reserved: Sequence[str] = ()) -> DataFrame:
    """Without columns that have no plain SQL type (vectors, arrays, maps, structs) and reserved names."""
    unfit = (T.ArrayType, T.MapType, T.StructType, T.UserDefinedType, T.BinaryType, T.VariantType)
    words = {w.lower() for w in reserved}
    return df.select(*[col(f.name) for f in df.schema.fields
                       if not isinstance(f.dataType, unfit) and f.name.lower() not in words])


def use_database(spark: SparkSession, name: str, select: bool = False, location: str | None = None) -> list[str]:
    """Create the database if needed, optionally make it current, and return all database names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`" + (f" LOCATION '{location}'" if location else ""))
    if select:
        spark.catalog.setCurrentDatabase(name)
    return sorted(d.name for d in spark.catalog.listDatabases())


def decoded_name(table: str) -> str:
    """The view that shows an external text table with its line breaks."""
    return f"{table}_text"


def create_external_csv(df: DataFrame, table: str, location: str) -> None:
    """Declare an external comma-separated table with the schema of ``df`` at a location, and the view that decodes
    its text (``decoded_name``)."""
    spark = df.sparkSession
    options = ", ".join(f"'{k}' = '{v.replace(chr(92), chr(92) * 2)}'" for k, v in CSV_OPTIONS.items())
    spark.sql(f"CREATE TABLE {table} ({schema_ddl(df)}) USING csv OPTIONS ({options}) LOCATION '{location}'")
    _create_view(spark, table)


def _create_view(spark: SparkSession, table: str) -> None:
    shown = []
    for f in spark.table(table).schema.fields:
        name = f"`{f.name.replace('`', '``')}`"
        text = name
        for plain, written in ESCAPES if isinstance(f.dataType, T.StringType) else ():
            code = " || ".join(f"char({ord(c)})" for c in written)
            text = f"replace({text}, {code}, char({ord(plain)}))"
        shown.append(f"{text} AS {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {decoded_name(table)} AS SELECT {', '.join(shown)} FROM {table}")


def write_external_csv(df: DataFrame, table: str, location: str) -> None:
    """Write rows to a fresh folder below ``location``, columns in the order of the table, and point the table there.

    The table moves in one catalog call after the write has worked, so a failed write leaves it as it was, and ``df``
    may read the table itself. Folders of earlier versions stay for readers that began before.
    """
    spark = df.sparkSession
    order = spark.table(table).columns
    missing = sorted(set(order) ^ set(df.columns))
    if missing:
        raise ValueError(f"columns do not match {table}: {missing}")
    fresh = f"{location.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    one_line(df.select(*[col(c) for c in order])).write.options(**CSV_OPTIONS).csv(fresh)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(table)


def publish_csv(df: DataFrame, table: str, location: str, reserved: Sequence[str] = ()) -> DataFrame:
    """Drop what cannot be published, write it, declare the table over it, and return it as read back and decoded.

    Any text survives, byte for byte. A table that has the same columns already keeps its declaration; another one is
    declared anew only after the rows are written.
    """
    plain = publishable(df, reserved)
    spark = plain.sparkSession
    if not (spark.catalog.tableExists(table) and schema_ddl(spark.table(table)) == schema_ddl(plain)):
        fresh = f"{location.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
        one_line(plain).write.options(**CSV_OPTIONS).csv(fresh)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        create_external_csv(plain, table, fresh)
    else:
        write_external_csv(plain, table, location)
        _create_view(spark, table)
    return spark.table(decoded_name(table))
