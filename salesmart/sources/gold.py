"""Gold tables: `;`-separated CSV with a header, published whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesmart.sources.published import Load, published, write_load
from salesmart.sources.raw import SEPARATOR


def write_gold(
    df: DataFrame, path: str, files: int | None = None, keep_blanks: bool = False, compression: str | None = None
) -> Load:
    """Write a table as CSV, replacing what is there once all of it is written.

    A failed write raises, and readers keep the table as it was; so do those that read while it
    is written.

    By default every task writes its own part. A reader that needs few files passes their
    number; the rows are then spread evenly over that many writers.

    The writer trims text, so that ` Bob ` comes out as `Bob`, though a key is made of the
    text as it was. With `keep_blanks` text stays as it is.

    Files are plain text; `compression` names a codec, such as gzip, that readers must know. Spark's
    own tell it by the names of the files. Gzip works at its least level, as text gains little by more.
    """
    if files is not None:
        df = df.repartition(files)

    def write(rows: DataFrame, at: str) -> None:
        writer = rows.write.option("header", True).option("sep", SEPARATOR)
        if compression is not None:
            writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
        for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
            writer = writer.option(side, not keep_blanks)
        writer.csv(at)

    return write_load(df, path, write)


def gold_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds a gold table's files at present."""
    loads = published(spark, path)
    if not loads:
        raise FileNotFoundError(f"no finished table at {path}")
    return f"{path.rstrip('/')}/{loads[-1].folder}"


def read_gold(
    spark: SparkSession, path: str, schema: T.StructType, line_feeds: bool = False
) -> DataFrame:
    """Read a gold table back with its types; CSV itself keeps none.

    The writer quotes empty text and leaves NULL blank. The reader takes both for NULL as
    long as its mark for NULL is empty too, hence another mark. Text that may hold line feeds
    is written in quotes; reading it back needs `line_feeds`, which keeps a file in one task.
    Raw text, being read by lines, cannot hold any.
    """
    reader = spark.read.schema(schema).option("header", True).option("sep", SEPARATOR)
    reader = reader.option("nullValue", "\u0000").option("multiLine", line_feeds)
    return reader.csv(gold_folder(spark, path))
