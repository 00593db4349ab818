"""Cleaning whole tables: every column by its declared type, in one projection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions import (
    NOT_INFORMED_TITLE,
    cast_date_iso,
    clean_string,
    fill_snapshot_date,
    null_to_token,
    parse_date_br,
    parse_number_br,
    parse_snapshot_date,
    whitespace_to_token,
)
from salesmart.schemas import SNAPSHOT, STAGE, columns_of_type

# The text columns the narrow stage cleans.
NARROW_TEXT = ["address_number", "city", "state", "country", "customer"]


def conform_column(field: T.StructField, dates=parse_date_br) -> Column:
    """A text column cleaned and typed as declared."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.DoubleType):
        c = parse_number_br(c)
    elif isinstance(field.dataType, T.DateType):
        c = parse_snapshot_date(c) if field.name == "data_foto" else dates(c)
    else:
        c = clean_string(c)
    return c.alias(field.name)


def conform_entity(
    df: DataFrame, schema: T.StructType, run_date: dt.date, iso_dates: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """One entity cleaned and typed, with the columns `keep` as they are.

    Dates are read as dd/MM/yyyy and the snapshot date as yyyyMMdd or ISO text. With
    `iso_dates` every date, the snapshot date too, goes through the plain cast, which knows
    ISO text only. A missing snapshot date is the day before the run.
    """
    snapshot = fill_snapshot_date(F.col(SNAPSHOT), run_date)
    if iso_dates:
        snapshot = cast_date_iso(snapshot)
    else:
        snapshot = F.coalesce(parse_snapshot_date(snapshot), cast_date_iso(snapshot))
    dates = cast_date_iso if iso_dates else parse_date_br
    return df.select(
        *[
            snapshot.alias(SNAPSHOT) if f.name == SNAPSHOT else conform_column(f, dates)
            for f in schema
        ],
        *keep,
    )


def conform_stage(stage: DataFrame) -> DataFrame:
    """The joined wide stage cleaned and typed."""
    return stage.select(*[conform_column(f) for f in STAGE])


def conform_narrow_text(c: Column, token: str = NOT_INFORMED_TITLE) -> Column:
    return null_to_token(whitespace_to_token(c, token), token)


def conform_narrow(stage: DataFrame, token: str = NOT_INFORMED_TITLE) -> DataFrame:
    """The narrow stage with its text columns cleaned; keys are made before this."""
    return stage.withColumns({c: conform_narrow_text(F.col(c), token) for c in NARROW_TEXT})


def date_reject_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: for each date column, how many values are given but are no dd/MM/yyyy date."""
    names = [n for n in columns_of_type(schema, T.DateType) if n != SNAPSHOT]
    return _reject_counts(df, names, parse_date_br)


def number_reject_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: for each number column, how many values are given but are no number."""
    return _reject_counts(df, columns_of_type(schema, T.DoubleType), parse_number_br)


# The columns that a row of rejects names, and the mark of a column's given value while failures are counted.
BAD_COLUMNS = "bad_columns"
GIVEN = "_given_"


def _is_bad(name: str, schema: T.StructType, iso_dates: bool) -> Column:
    parse = parse_number_br
    if isinstance(schema[name].dataType, T.DateType):
        parse = cast_date_iso if iso_dates else parse_date_br
    return F.col(name).isNotNull() & parse(F.col(name)).isNull()


def parsed_columns(schema: T.StructType) -> list[str]:
    """The columns whose text may be no value: dates, but for the snapshot's, and numbers."""
    return [f.name for f in schema if not isinstance(f.dataType, T.StringType) and f.name != SNAPSHOT]


def conform_counting(
    df: DataFrame, schema: T.StructType, run_date: dt.date, iso_dates: bool = False
) -> tuple[DataFrame, Observation]:
    """`conform_entity`, and an observation that has, once the rows were written, how many values
    of each column are given but are no number or date. Nothing is scanned or parsed for it again:
    what was given and is NULL once it is cleaned has failed."""
    names = parsed_columns(schema)
    given = {f"{GIVEN}{name}": F.col(name).isNotNull() for name in names}
    cleaned = conform_entity(df.withColumns(given), schema, run_date, iso_dates, keep=list(given))
    seen = Observation()
    counts = [F.count_if(F.col(f"{GIVEN}{name}") & F.col(name).isNull()).alias(name) for name in names]
    return (cleaned.observe(seen, *counts) if counts else cleaned).select(*schema.names), seen


def reject_rows(df: DataFrame, schema: T.StructType, iso_dates: bool = False) -> DataFrame:
    """The rows with a value that is no number or date, as they arrived, and the names of those
    columns, comma-joined in contract order.

    The names are unpacked from an array, as a filter on them would else be pushed below the
    projection, and all values parsed once for the filter and once more for the names.
    """
    bad = [F.when(_is_bad(name, schema, iso_dates), name) for name in parsed_columns(schema)]
    if not bad:
        return df.withColumn(BAD_COLUMNS, F.lit("")).where("false")
    named = df.withColumn(BAD_COLUMNS, F.array(F.concat_ws(",", *bad)))
    return named.withColumn(BAD_COLUMNS, F.explode_outer(BAD_COLUMNS)).where(F.col(BAD_COLUMNS) != "")


def _reject_counts(df: DataFrame, names: list[str], parse) -> DataFrame:
    return df.agg(
        *[
            F.count_if(F.col(n).isNotNull() & parse(F.col(n)).isNull()).alias(n)
            for n in names
        ]
    )
