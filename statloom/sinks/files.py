"""Results out as files, and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import col
from statloom.functions.linetext import CSV_OPTIONS, one_line


def save_parquet(df: DataFrame, path: str, sort_keys: Sequence[str] = (), partition_by: Sequence[str] = (),
                 files: int | None = None) -> None:
    """Overwrite a parquet directory.

    With ``sort_keys`` rows are ranged over the tasks and sorted within them: files follow each other in key
    order, which is what a global sort would give, and readers can skip files by key. Rows of one frequent key are
    spread over several tasks by a hash of the whole row, which comes after the keys.
    """
    if sort_keys:
        keys = [col(k) for k in sort_keys]
        hashed = [col(f.name) for f in df.schema.fields if not _holds_map(f.dataType)]
        spread = [*keys, F.xxhash64(*hashed)]
        ranged = df.repartitionByRange(files, *spread) if files else df.repartitionByRange(*spread)
        df = ranged.sortWithinPartitions(*keys)
    elif files:
        df = df.repartition(files)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def _holds_map(kind: T.DataType) -> bool:
    """Types that Spark does not hash."""
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def written_rows(spark: SparkSession, path: str) -> int:
    """Rows of a parquet directory, from the file footers. Unlike a counter kept while writing, it stays exact when
    lost tasks were run again."""
    return spark.read.parquet(path).count()


def save_csv(df: DataFrame, path: str, header: bool = True, files: int | None = None) -> None:
    """Overwrite a CSV directory. ``files=1`` gives one file and is meant for result tables: it sends all rows
    through one writer, while the computation before it keeps its parallelism. Text with line breaks, quotes, spaces at
    the ends, nulls and empty text come back as they were with ``read_csv``."""
    if files:
        df = df.repartition(files)
    one_line(df).write.mode("overwrite").options(**CSV_OPTIONS).option("header", header).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
