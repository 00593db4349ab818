"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_key(*parts: Column, sep: str = "") -> Column:
    """The parts as one text; NULL parts are skipped.

    With the empty separator ('1', '23') and ('12', '3') give the same text. That is the
    form existing keys have; a separator avoids it.
    """
    return F.concat_ws(sep, *parts)


def surrogate_key(*parts: Column, sep: str = "") -> Column:
    """SHA-256 of the concatenated parts, in lower-case hex."""
    return F.sha2(concat_key(*parts, sep=sep), 256)
