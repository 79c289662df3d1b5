"""Column rules, value by value."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tariffbook.functions import dates, numbers, text


def apply(spark, rule, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_country(spark):
    cases = {
        "USA": "United States", "us": "United States", " United STATES ": "United States", " US ": "United States",
        "U.K.": "United Kingdom", "England": "United Kingdom", "CAN": "Canada", "canada": "Canada",
        "uk": "uk", "gb": "gb", "u.s.": "u.s.", " France ": "France", "": "Unknown", "   ": "Unknown", None: "Unknown",
        "\t": "\t", "Unknown": "Unknown",
    }
    assert apply(spark, text.normalise_country, list(cases)) == list(cases.values())


def test_phone(spark):
    cases = {
        "555-123-4567": "555-123-4567", "(555) 234.5678": "555-234-5678", "5551234567": "555-123-4567",
        "555 567 8901": "555-567-8901", "+1 555 234 5678": None, "555123456": None, "": None, None: None,
        "call 555x123y4567": "555-123-4567", "٥٥٥١٢٣٤٥٦٧": "٥٥٥-١٢٣-٤٥٦٧",
    }
    assert apply(spark, text.normalise_phone, list(cases)) == list(cases.values())
    assert apply(spark, text.normalise_phone, [5551234567], "bigint") == ["555-123-4567"]


def test_email(spark):
    valid = ["a@b.com", " a@b.com ", "\ta@b.com\n", "a.b+c@d.e.f", "a@b..c", " a@b.c ", "a@.b.c"]
    invalid = [
        None, "", "  ", "a", "a@b", "@b.c", "a@@b.c", "a@b.c@d.e", "a b@c.d", "a@b c.d", "a@b.", "a b@c.d",
        "a@b.c d", "a @b.c", "a@.c",
    ]
    assert apply(spark, text.is_valid_email, valid) == [True] * len(valid)
    assert apply(spark, text.is_valid_email, invalid) == [False] * len(invalid)


def test_name(spark):
    cases = {None: "Unknown", "": "Unknown", "  ": "Unknown", " Ann ": " Ann ", "\t": "\t"}
    assert apply(spark, text.fill_name, list(cases)) == list(cases.values())


def test_trim_strings(spark):
    df = spark.createDataFrame([(" a ", 1, None), ("\tb ", 2, " c")], "x string, y int, z string")
    assert [tuple(r) for r in text.trim_strings(df).collect()] == [("a", 1, None), ("\tb", 2, "c")]


def test_document_tokens(spark):
    words = apply(spark, text.words_with_at, ["mail a@b.c, d@e now", "none", ""])
    assert words == [["a@b.c,", "d@e"], [], []]
    # A phone stands alone: no digit, dot or letter directly beside it.
    cases = {
        "at (555) 234-5678 or 555.345.6789.": ["(555) 234-5678", "555.345.6789"],
        "555.345.6789x": [],
        "12": [],
        "555-123-4567 555-123-4568": ["555-123-4567", "555-123-4568"],
        "13.149.130.89 and 190.137.223.204": [],
        "+1 (826) 555-4081 190.137.223.204": ["+1 (826) 555-4081"],
        "card 4785380592391139, 4785 3805 9239 1139": [],
    }
    assert apply(spark, text.phone_tokens, list(cases)) == list(cases.values())


def test_dates(spark):
    cases = {
        "1/2/2024": date(2024, 1, 2), "01/02/2024": date(2024, 1, 2), "12/31/2023": date(2023, 12, 31),
        "2024-01-02": date(2024, 1, 2), "2/30/2024": None, "2023-02-29": None, "13/1/2024": None, "junk": None,
        "": None, None: None, "2024/01/02": None, "1/2/24": None, "1-2-2024": None,
    }
    assert apply(spark, dates.parse_date, list(cases)) == list(cases.values())
    assert apply(spark, dates.parse_iso_date, ["2024-01-02", "junk", None]) == [date(2024, 1, 2), None, None]
    assert apply(spark, dates.end_or_open, [None, "junk", "1/1/2024"]) == [dates.OPEN_END, None, date(2024, 1, 1)]


def test_active_flag(spark):
    def flag(c):
        return dates.active_flag(c, date(2024, 6, 1))

    values = [date(2024, 6, 1), date(2024, 5, 31), dates.OPEN_END, None]
    assert apply(spark, flag, values, "date") == ["Y", "N", "Y", "N"]


@pytest.mark.parametrize(
    ("start", "end", "days", "long_term"),
    [
        (date(2024, 4, 10), date(2024, 10, 10), 183, False),
        (date(2024, 3, 25), date(2024, 9, 25), 184, True),
        (date(2024, 5, 1), None, 31, False),
        (date(2024, 5, 1), date(2024, 4, 1), -30, False),
        (None, date(2024, 4, 1), None, None),
    ],
)
def test_duration(spark, start, end, days, long_term):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    length = dates.duration_days(F.col("s"), F.col("e"), date(2024, 6, 1))
    assert tuple(df.select(length, dates.is_long_term(length)).first()) == (days, long_term)


def test_run_date_defaults_to_today(spark):
    row = spark.range(1).select((dates.run_date(None) == F.current_date()).alias("same")).first()
    assert row.same


def test_numbers(spark):
    # Amounts keep their decimals until they are summed, and may be long.
    assert apply(spark, numbers.money, ["9.99", "-5", "junk", "", None, "1.23456", "123456789012345678.5"]) == [
        Decimal("9.9900"), Decimal("-5.0000"), None, None, None, Decimal("1.23456"), Decimal("123456789012345678.5"),
    ]
    assert apply(spark, numbers.charge_or_zero, ["9.99", "junk", None]) == [Decimal("9.99"), Decimal(0), Decimal(0)]
    assert apply(spark, numbers.money, [9.99, None], "double") == [Decimal("9.9900"), None]


@pytest.mark.parametrize(
    ("values", "total", "mean"),
    [
        (["4.1", "4.1", "4.1", "4.0"], 16.3, 4.08),
        (["0.005"], 0.01, 0.01),
        (["-0.005"], -0.01, -0.01),
        (["1", "1", "2"], 4.0, 1.33),
        (["-1", "-1", "-2"], -4.0, -1.33),
        (["0", "0"], 0.0, 0.0),
        (["4.25", None], 4.25, 4.25),
        (["0.0049999999"], 0.0, 0.0),
        (["0.0049999999", "0.0050000001"], 0.01, 0.01),
        (["123456789012.3", "123456789012.4"], 246913578024.7, 123456789012.35),
        ([None, None], None, None),
    ],
)
def test_sum_and_mean(spark, values, total, mean):
    df = spark.createDataFrame([(v,) for v in values], "v string").select(numbers.money(F.col("v")).alias("v"))
    assert tuple(df.agg(numbers.sum_2dp(F.col("v")), numbers.mean_2dp(F.col("v"))).first()) == (total, mean)


def test_sign_counts_before_rounding(spark):
    assert apply(spark, numbers.not_negative, ["-0.00001", "0", "0.00001", "x", None]) == [False, True, True, None, None]
