"""Raw `;`-separated text with one header line per file."""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = ";"
NULL_MARK = r"\N"
# The column of lines that hold the reader's separator.
WHOLE_LINE = "_bad"


def normalise_name(name: str) -> str:
    return name.lower().replace(" ", "_").replace("/", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names, with blanks and slashes as underscores."""
    return df.toDF(*[normalise_name(name) for name in df.columns])


def entity_name(path: str) -> str:
    """The entity a file or directory holds: its name up to the first dot, in lower case."""
    return path.rstrip("/").rsplit("/", 1)[-1].split(".")[0].lower()


def schema_from_header(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Normalised column names from the header line of one of the files. Every column is text."""
    return _names(header_line(spark, path))


def header_line(spark: SparkSession, path: str | Sequence[str]) -> str:
    """The header line of one of the files, as it is."""
    return _line_reader(spark).csv(path).columns[0]


def _names(header: str) -> list[str]:
    return [normalise_name(name.strip()) for name in header.split(SEPARATOR)]


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """Each header line found, with the files that have it, in order.

    A file's first line is the one read first of its first block. Files without a line have none.
    """
    place = ["_metadata.file_path", "_metadata.file_block_start"]
    lines = spark.read.text(path).select("value", *place, F.monotonically_increasing_id().alias("at"))
    first = lines.where("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.orderBy("file_path").collect():  # one row for each file
        found.setdefault(row.header.rstrip("\r"), []).append(_as_path(row.file_path))
    return found


def _as_path(uri: str) -> str:
    """A file's address as a path that a reader takes for this file alone."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def check_columns(found: Sequence[str], declared: Sequence[str], where: str) -> None:
    """Raise if a declared column is missing; warn of columns nobody declared.

    Without this a misspelt header would load, and every value of the column it hides would
    be cleaned to the token for missing text or to zero. The order does not matter.
    """
    missing = [name for name in declared if name not in found]
    unknown = [name for name in found if name not in declared]
    if missing:
        raise ValueError(f"{where}: no column {', '.join(missing)}; not declared: {', '.join(unknown) or 'none'}")
    if unknown:
        warnings.warn(f"{where}: columns not declared: {', '.join(unknown)}", stacklevel=3)


def _fields(line: Column, columns: Sequence[str]) -> list[Column]:
    parts = F.split(line, SEPARATOR, -1)
    return [F.nullif(F.get(parts, F.lit(i)), F.lit(NULL_MARK)).alias(name) for i, name in enumerate(columns)]


def scan_raw(
    spark: SparkSession, path: str | Sequence[str], columns: list[str] | None = None, blank_lines: bool = False
) -> DataFrame:
    r"""Raw rows, all text: empty fields stay "", \N and missing trailing fields are NULL.

    The CSV reader cannot tell an empty field from NULL, so it is used only to drop the
    header of each file and to split files; it hands over whole lines. Its separator option
    is a control character; a line that does hold one is handed over in the column for
    corrupt records, whole as well. Quotes have no meaning. Fields beyond the columns are
    left out and counted by `raw_reject_counts`.

    All files must have the same header, but for upper and lower case. The reader compares each
    file's while it scans, and raises with the name of a file that has another;
    `scan_by_header` reads such files.

    The CSV reader skips blank lines, which are counted as rejects. With `blank_lines` they
    are rows too, as a plain text table has them: the blank text, then NULL. That reads the
    text a second time, for those lines alone.
    """
    header = header_line(spark, path)
    columns = columns or _names(header)
    named = T.StructType([T.StructField(header, T.StringType()), T.StructField(WHOLE_LINE, T.StringType())])
    reader = _line_reader(spark).option("enforceSchema", False).option("columnNameOfCorruptRecord", WHOLE_LINE)
    lines = reader.schema(named).csv(path).toDF("line", WHOLE_LINE)
    rows = lines.select(*_fields(F.coalesce(WHOLE_LINE, "line"), columns))
    if blank_lines:
        blank = _text_lines(spark, path).where(_is_blank())
        rows = rows.union(blank.select(*_fields(F.col("value"), columns)))
    return rows


def scan_by_header(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], headers: Mapping[str, list[str]] | None = None
) -> DataFrame:
    """The columns given of raw files that may have them in different order.

    Files with the same header are scanned together, by their own order. A file that lacks a
    column is refused by name; columns nobody asked for are left out with a warning.
    """
    headers = file_headers(spark, path) if headers is None else headers
    if not headers:
        raise FileNotFoundError(f"no header in any file of {path}")
    for header, files in headers.items():
        check_columns(_names(header), columns, ", ".join(files[:3]) + (" ..." if len(files) > 3 else ""))
    scans = [scan_raw(spark, files, _names(header)).select(*columns) for header, files in headers.items()]
    return reduce(DataFrame.union, scans)


def headers_differ(error: Exception) -> bool:
    """Whether a scan failed because a file's header is not that of the others."""
    return "CSV header does not conform" in str(error)


def _line_reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("header", True).option("sep", "\u0001").option("quote", "")


def _text_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.text(path)


def _is_blank() -> Column:
    """What the CSV reader skips: lines of nothing but characters up to the space."""
    return ~F.col("value").rlike(r"[^\x00-\x20]")


def raw_reject_counts(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """One row: how many lines are blank, have more fields than the header, or have fewer."""
    columns = columns or schema_from_header(spark, path)
    fields = F.size(F.split("value", SEPARATOR, -1))
    return _text_lines(spark, path).agg(
        F.count_if(_is_blank()).alias("blank_lines"),
        F.count_if(~_is_blank() & (fields > len(columns))).alias("wide_lines"),
        F.count_if(~_is_blank() & (fields < len(columns))).alias("short_lines"),
    )
