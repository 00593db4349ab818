"""Dates from text, and the calendar parts of a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_BR = r"\A( [1-9]|\d{1,2})/\d{1,2}/(?!0000)\d{4}\z"
DATE_SNAPSHOT = r"\A\d{8}\z"


def parse_date_br(c: Column) -> Column:
    """dd/MM/yyyy to a date; anything else, and days that do not exist, give NULL.

    The parts are put in ISO order and cast, so neither the session's time zone nor its
    time parser setting can change the result.
    """
    year = F.substring_index(c, "/", -1)
    month = F.substring_index(F.substring_index(c, "/", 2), "/", -1)
    day = F.trim(F.substring_index(c, "/", 1))
    return F.when(c.rlike(DATE_BR), F.concat_ws("-", year, month, day)).try_cast("date")


def cast_date_iso(c: Column) -> Column:
    """The plain cast: ISO text parses, dd/MM/yyyy and yyyyMMdd give NULL."""
    return c.try_cast("date")


def parse_snapshot_date(c: Column) -> Column:
    """yyyyMMdd, the form of the snapshot partitions, to a date."""
    iso = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(c.rlike(DATE_SNAPSHOT), iso).try_cast("date")


def snapshot_day(run_date: dt.date) -> dt.date:
    """A run loads the state of the day before."""
    return run_date - dt.timedelta(days=1)


def fill_snapshot_date(c: Column, run_date: dt.date) -> Column:
    """A missing snapshot date becomes the day before the run, as ISO text."""
    return F.coalesce(c, F.lit(snapshot_day(run_date).isoformat()))


def calendar_columns(c: Column) -> dict[str, Column]:
    """Year, month, quarter and ISO week of a date, by output name."""
    return {
        "_year": F.year(c),
        "_month": F.month(c),
        "_quarter": F.quarter(c),
        "_weekofyear": F.weekofyear(c),
    }
