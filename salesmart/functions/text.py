"""Cleaning of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two spellings of the token for missing text.
NOT_INFORMED = "Não informado"
NOT_INFORMED_TITLE = "Não Informado"

# Every Unicode blank; Java's \s alone is ASCII only.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANK_RUN = f"[{BLANKS}]{{2,}}"
# No blank is printable ASCII, so text without two other characters side by side has no run.
MAYBE_RUN = r"[^!-~][^!-~]"


def clean_string(c: Column, token: str = NOT_INFORMED) -> Column:
    """Missing text becomes the token; a blank run inside text becomes one space.

    Missing is NULL, empty, or anything that starts with a run of two or more blanks.
    Otherwise the first run found is replaced wherever that exact run occurs; runs of
    another length or kind stay as they are.
    """
    # Most text has no run, so that is asked first, by one range: the search for the blanks themselves
    # takes three times as long.
    first_run = F.regexp_extract(c, BLANK_RUN, 0)
    return (
        F.when(c.isNull() | (c == ""), F.lit(token))
        .when(~c.rlike(MAYBE_RUN), c)
        .when(~c.rlike(BLANK_RUN), c)
        .when(c.rlike(r"\A" + BLANK_RUN), F.lit(token))
        .otherwise(F.replace(c, first_run, F.lit(" ")))
    )


def whitespace_to_token(c: Column, token: str = NOT_INFORMED_TITLE) -> Column:
    """Every run of two or more ASCII blanks becomes the token, in place."""
    return F.regexp_replace(c, r"\s{2,}", token)


def null_to_token(c: Column, token: str = NOT_INFORMED_TITLE) -> Column:
    return F.coalesce(c, F.lit(token))
