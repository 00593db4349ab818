"""Scalar functions as tables of input and output."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from salesmart import functions as fn
from salesmart.functions.text import BLANK_RUN, BLANKS

NI = fn.NOT_INFORMED
NIT = fn.NOT_INFORMED_TITLE


def apply(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    rows = df.select("i", function(F.col("c")).alias("c")).collect()
    return [row.c for row in sorted(rows)]


def check(spark, function, cases):
    got = apply(spark, function, [given for given, _ in cases])
    assert list(zip([given for given, _ in cases], got)) == cases


def test_clean_string(spark):
    check(
        spark,
        fn.clean_string,
        [
            ("", NI),
            ("    ", NI),
            ("New York", "New York"),
            ("New  York", "New York"),
            (None, NI),
            ("  New York", NI),
            (" x", " x"),
            (" ", " "),
            ("a  b   c", "a b  c"),
            ("a   b  c", "a b  c"),
            ("a  b  c", "a b c"),
            ("a  b    c", "a b  c"),
            ("abc   ", "abc "),
            ("a\t\nb", "a b"),
            ("a\t b \tc", "a b \tc"),
            ("\n\n", NI),
            ("a\nb", "a\nb"),
            ("x\n  y", "x y"),
            ("cost $1  \\2", "cost $1 \\2"),
        ],
    )


@pytest.mark.parametrize(
    "blank",
    [chr(i) for i in range(0x10000) if chr(i).isspace()],
    ids=lambda c: f"U+{ord(c):04X}",
)
def test_clean_string_counts_every_unicode_blank(spark, blank):
    assert apply(spark, fn.clean_string, [blank * 2, f"a{blank}{blank}b", f"a{blank}b"]) == [
        NI,
        "a b",
        f"a{blank}b",
    ]


def test_blank_run_takes_nothing_else(spark):
    others = [chr(i) for i in range(1, 0xD800) if not chr(i).isspace()]
    df = spark.createDataFrame([(c * 2,) for c in others], "c string")
    assert df.where(F.col("c").rlike(BLANK_RUN)).count() == 0


def test_text_tokens(spark):
    check(
        spark,
        fn.whitespace_to_token,
        [
            ("New  York", f"New{NIT}York"),
            ("", ""),
            ("a b", "a b"),
            ("  a  ", f"{NIT}a{NIT}"),
            (None, None),
        ],
    )
    check(spark, fn.null_to_token, [(None, NIT), ("", ""), ("a", "a")])
    assert apply(spark, lambda c: fn.null_to_token(c, NI), [None]) == [NI]


def test_blank_to_zero(spark):
    check(spark, fn.blank_to_zero, [("", "0.0"), (None, "0.0"), ("  ", "  "), ("1,5", "1,5")])


def test_parse_number_br_ignores_all_blanks_around(spark):
    given = [f"{b}1.234,56{b}" for b in BLANKS] + ["\u00a05d\u2009", "\u2009inf\u00a0", "1 234", "\u00a0"]
    assert apply(spark, fn.parse_number_br, given) == [1234.56] * len(BLANKS) + [None, math.inf, None, None]
    assert apply(spark, fn.parse_number_us, ["\u00a01", " 1,5\t"]) == [None, 15.0]


def test_parse_number_br(spark):
    check(
        spark,
        fn.parse_number_br,
        [
            ("", 0.0),
            (None, 0.0),
            ("0.0", 0.0),
            ("1.234,56", 1234.56),
            ("1234.56", 123456.0),
            ("-1.000,5", -1000.5),
            (" 12,5 ", 12.5),
            ("\t12,5\t", 12.5),
            ("1e3", 1000.0),
            ("+7", 7.0),
            (",5", 0.5),
            ("inf", math.inf),
            ("-INF ", -math.inf),
            ("Infinity", math.inf),
            ("abc", None),
            ("   ", None),
            ("1,2,3", None),
            ("5d", None),
            ("5D ", None),
            ("5f", None),
            ("5F\t", None),
            ("5d.", None),
            ("5f .", None),
            ("1 2", None),
        ],
    )
    assert math.isnan(apply(spark, fn.parse_number_br, ["nan"])[0])


def test_parse_number_us(spark):
    check(
        spark,
        fn.parse_number_us,
        [
            ("1,234.5", 1234.5),
            ("1234.5", 1234.5),
            (" -7 ", -7.0),
            ("", None),
            (None, None),
            ("n/d", None),
            ("5f", None),
            ("5d,", None),
        ],
    )


def test_parse_date_br(spark):
    cases = [
        ("31/12/2019", dt.date(2019, 12, 31)),
        ("1/2/2020", dt.date(2020, 2, 1)),
        (" 1/2/2020", dt.date(2020, 2, 1)),
        ("29/02/2020", dt.date(2020, 2, 29)),
        ("01/01/0001", dt.date(1, 1, 1)),
        ("31/02/2020", None),
        ("29/02/2019", None),
        ("1/13/2020", None),
        ("0/1/2020", None),
        ("1/1/20", None),
        ("001/1/2020", None),
        ("1/1/0000", None),
        ("1/1/2020 ", None),
        ("1/1/2020\n", None),
        ("20200101", None),
        ("2020-01-01", None),
        ("", None),
        (None, None),
    ]
    check(spark, fn.parse_date_br, cases)


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Pacific/Apia"])
def test_dates_do_not_depend_on_the_session(spark, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Midnight, or the whole day, is missing from these days in those zones.
        given = ["15/10/2017", "30/12/2011"]
        assert apply(spark, fn.parse_date_br, given) == [
            dt.date(2017, 10, 15),
            dt.date(2011, 12, 30),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_other_dates(spark):
    check(
        spark,
        fn.cast_date_iso,
        [
            ("2020-01-01", dt.date(2020, 1, 1)),
            ("31/12/2019", None),
            ("20200101", None),
            ("", None),
            (None, None),
        ],
    )
    check(
        spark,
        fn.parse_snapshot_date,
        [
            ("20200131", dt.date(2020, 1, 31)),
            ("20200231", None),
            ("2020-01-31", None),
            ("202001311", None),
            (None, None),
        ],
    )
    run = dt.date(2024, 3, 1)
    assert apply(spark, lambda c: fn.fill_snapshot_date(c, run), [None, "", "20240101"]) == [
        "2024-02-29",
        "",
        "20240101",
    ]


def test_calendar_follows_iso_weeks(spark):
    df = spark.createDataFrame(
        [(dt.date(2021, 1, 1),), (dt.date(2019, 12, 30),), (None,)], "d date"
    )
    parts = fn.calendar_columns(F.col("d"))
    rows = df.select(*[c.alias(n) for n, c in parts.items()]).collect()
    assert [tuple(r) for r in rows] == [(2021, 1, 1, 53), (2019, 12, 4, 1), (None,) * 4]


def test_surrogate_key(spark):
    df = spark.createDataFrame(
        [("1", "23", dt.date(2020, 1, 2)), ("12", "3", None), (None, None, None)],
        "a string, b string, d date",
    )
    parts = [F.col("a"), F.col("b"), F.col("d"), F.year("d")]
    plain = [r[0] for r in df.select(fn.surrogate_key(*parts)).collect()]
    assert plain == [
        hashlib.sha256(text.encode()).hexdigest() for text in ("1232020-01-022020", "123", "")
    ]
    short = [F.col("a"), F.col("b")]
    joined = [r[0] for r in df.select(fn.surrogate_key(*short)).collect()]
    apart = [r[0] for r in df.select(fn.surrogate_key(*short, sep="|")).collect()]
    assert joined[0] == joined[1] and apart[0] != apart[1]
