"""Numbers from text. Text that is no number gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.text import BLANKS

# The blanks that Spark's own cast ignores around a number.
CAST_BLANKS = " \t\n\x0b\x0c\r"


def blank_to_zero(c: Column) -> Column:
    """Missing numbers, NULL or empty, become the text 0.0."""
    return F.when(c.isNull() | (c == ""), F.lit("0.0")).otherwise(c)


def _has_suffix(text: Column, blanks: str, dropped: str) -> Column:
    """Whether text ends in a Java type suffix such as 5d, which a cast would take.

    What the cast ignores and the marks that are dropped may follow it. The search for
    infinity is made for such endings alone.
    """
    last = F.right(F.rtrim(text, F.lit(blanks + dropped)), F.lit(1))
    infinite = F.rtrim(F.replace(text, F.lit(dropped), F.lit("")), F.lit(blanks)).rlike(r"(?i)inf\z")
    return last.isin("d", "D", "f", "F") & ~infinite


def parse_number_br(c: Column) -> Column:
    """1.234,56 to a double: points group thousands, the comma is the decimal mark.

    Blanks of any kind around the number are ignored. Text from a digit or sign to a digit, as
    almost all of it is, has neither blanks nor a suffix, and is not searched for them.
    """
    text = blank_to_zero(c)
    tidy = F.left(text, F.lit(1)).between("-", "9") & F.right(text, F.lit(1)).between("0", "9")
    bare = F.when(tidy, text).when(~_has_suffix(c, BLANKS, "."), F.btrim(text, F.lit(BLANKS)))
    plain = F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast("double")


def parse_number_us(c: Column) -> Column:
    """1,234.56 to a 32-bit float: commas group thousands."""
    plain = F.replace(c, F.lit(","), F.lit(""))
    return F.when(_has_suffix(c, CAST_BLANKS, ","), None).otherwise(plain).try_cast("float")
