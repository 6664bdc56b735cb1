"""Delimited text in which one record is one line, whatever the values hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import col

# What text files cannot tell apart otherwise, and no trimming of spaces.
CSV_OPTIONS = {"header": "false", "nullValue": "\\N", "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
# How text is written so that one record is one line. The first two come first when decoding.
ESCAPES = [("\n", "\\n"), ("\r", "\\r"), ("\\", "\\s")]


def _per_text(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name)
                       for f in df.schema.fields])


def one_line(df: DataFrame) -> DataFrame:
    """Text columns with line feeds, carriage returns and backslashes written as ``\\n``, ``\\r`` and ``\\s``.

    Files of such rows can be split at any line, which ``multiLine`` reading would end. ``\\N`` stays free for null.
    """
    def encode(text: Column) -> Column:
        for plain, written in reversed(ESCAPES):  # backslashes first
            text = F.replace(text, F.lit(plain), F.lit(written))
        return text
    return _per_text(df, encode)


def many_lines(df: DataFrame) -> DataFrame:
    """Undo ``one_line``. Every backslash opens a pair, so the pairs can be replaced one kind after the other."""
    def decode(text: Column) -> Column:
        for plain, written in ESCAPES:
            text = F.replace(text, F.lit(written), F.lit(plain))
        return text
    return _per_text(df, decode)
