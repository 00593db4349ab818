"""Rows whose text travels as one value, for a shuffle that all columns of a wide table take.

A row that is shuffled has a word for the place of each text and is padded to words after it, so of
a row of many short texts most is no text. As one text with separators they are about half as many
bytes once compressed. What it costs: of a packed column either all is moved or nothing, so it is
for rows whose columns are all wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column that holds the texts, and between it and the rows the column of their array.
PACKED = "_texts"
PARTS = "_parts"

SEPARATOR = "\x1f"
MARK = "\x1e"
# A value that is NULL, and the start of a row whose texts are in hexadecimal digits.
NULL = f"{MARK}n"
HEX = f"{MARK}x"


def texts_of(df: DataFrame, *but: str) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in but]


def _joined(values: list[Column]) -> Column:
    return F.concat_ws(SEPARATOR, *[F.coalesce(value, F.lit(NULL)) for value in values])


def packed(df: DataFrame, names: list[str]) -> DataFrame:
    """df with the texts of `names` in one column.

    Every text comes out of `unpacked` as it was, byte for byte. A row in which one holds a
    separator, a mark or bytes that are no UTF-8 has all of them in hexadecimal digits.
    """
    texts = [F.col(name) for name in names]
    plain, bare = _joined(texts), F.concat_ws("", *texts)
    odd = bare.contains(SEPARATOR) | bare.contains(MARK) | ~F.is_valid_utf8(plain)
    text = F.when(odd, F.concat(F.lit(HEX), _joined([F.hex(value) for value in texts]))).otherwise(plain)
    return df.select(*[F.col(c) for c in df.columns if c not in names], text.alias(PACKED))


def unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    """df, in which the column of `packed` is, with the texts of `names` as columns again."""
    odd = F.col(PACKED).startswith(HEX)
    body = F.when(odd, F.substring(PACKED, len(HEX) + 1, 2**31 - 1)).otherwise(F.col(PACKED))
    parts = df.withColumn(PARTS, F.split(body, SEPARATOR, -1))
    given = [F.nullif(F.get(PARTS, F.lit(i)), F.lit(NULL)) for i in range(len(names))]
    texts = [F.when(odd, F.unhex(part).cast("string")).otherwise(part).alias(n) for part, n in zip(given, names, strict=True)]
    return parts.select(*[F.col(c) for c in df.columns if c != PACKED], *texts)
