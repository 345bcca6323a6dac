"""Row rules on their edge cases, with ANSI mode on and off."""

import datetime
import random

from pyspark.sql import functions as F

from tractscope.functions.dates import parse_date, parse_date_by
from tractscope.functions.income import has_income, income_level
from tractscope.functions.numbers import is_code, parse_int
from tractscope.functions.tracts import normalize_tract, tract_or_unknown


def test_parse_int(either_mode, values):
    expected = {
        "1": 1, "123.7": 123, " 7 ": 7, "-3.9": -3, "0": 0, "-25": -25, "+5": 5, "1.": 1,
        ".5": 0, "0.9999999": 0, "-0.5": 0, "\t3\n": 3,
        "NA": None, "": None, " ": None, "1e2": None, "99999999999": None, "1d": None,
        "12 3": None, "-": None, "2147483648.1": None, None: None,
    }
    assert values(lambda c: parse_int(F.col(c)), expected) == expected


def test_is_code(either_mode, values):
    expected = {"1": True, "1.0": True, " 1": True, "01": True, "2": False, "11": False}
    assert values(lambda c: is_code(F.col(c), 1), expected) == expected
    assert values(lambda c: is_code(F.col(c), 1), ["x", None]) == {"x": None, None: None}


def test_income_present(values):
    expected = {None: False, 0: True, 5: True, -5: True}
    assert values(lambda c: has_income(F.col(c)), expected, "int") == expected


def test_income_level(either_mode, values):
    expected = {
        -25: -1, -20: 0, -5: 0, 0: 1, 19: 1, 20: 2, 39: 2, 40: 3, 479: 24, 480: 25, 499: 25,
        500: 25, 900: 25,
    }
    assert values(lambda c: income_level(F.col(c)), expected, "int") == expected


def test_normalize_tract(values):
    expected = {
        "0101.00": "06075010100",
        "101.00": "0607510100",
        "06075010100": "06075010100",
        "NA": "06075NA",
        "": "06075",
        "12345.67890": "12345.67890",
        None: None,
    }
    assert values(lambda c: normalize_tract(F.col(c), F.lit("06075")), expected) == expected
    assert values(lambda c: tract_or_unknown(F.col(c)), ["x", None]) == {"x": "x", None: "n/a"}


def day(year, month, date):
    return datetime.date(year, month, date)


def test_parse_date(either_mode, values):
    month_first = {
        "01/15/2012": day(2012, 1, 15),
        "01/15/2012 12:00:00 AM": day(2012, 1, 15),
        " 1/5/2012": day(2012, 1, 5),
        "12/31/2012T10:00": day(2012, 12, 31),
        "13/01/2012": None,
        "02/30/2012": None,
        "2018/03/04": None,
        "2018-03-04": None,
        "junk": None,
        "": None,
        "line\nbreak": None,
        None: None,
    }
    for pattern in ["MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss"]:
        assert values(lambda c: parse_date(F.col(c), pattern), month_first) == month_first
    year_first = {
        "2018/03/04": day(2018, 3, 4),
        "2018/3/4": day(2018, 3, 4),
        "2018/03/04 10:00": day(2018, 3, 4),
        "01/15/2012": None,
        "2018-03-04": None,
    }
    assert values(lambda c: parse_date(F.col(c), "yyyy/MM/dd"), year_first) == year_first


def test_parse_date_other_patterns(values):
    expected = {"15.01.2012": day(2012, 1, 15), "15/01/2012": None}
    assert values(lambda c: parse_date(F.col(c), "dd.MM.yyyy"), expected) == expected
    expected = {"15 Jan 2012": day(2012, 1, 15), "x": None}
    assert values(lambda c: parse_date(F.col(c), "dd MMM yyyy"), expected) == expected


def test_parse_date_by_row(values):
    slash = F.col("v").contains("/")
    patterns = [(slash, "MM/dd/yyyy"), (~slash, "yyyy-MM-dd"), (slash, "MM/dd/yyyy HH:mm:ss")]
    expected = {"01/15/2012": day(2012, 1, 15), "2012-01-15": day(2012, 1, 15), "junk": None}
    assert values(lambda c: parse_date_by(F.col(c), patterns), expected) == expected


def random_texts(alphabet, longest, count, seed=3):
    pick = random.Random(seed)
    texts = {"".join(pick.choices(alphabet, k=pick.randint(0, longest))) for _ in range(count)}
    return sorted(texts)


def test_parse_int_equals_the_lenient_cast(spark, values):
    """The rule is the cast to int of a session without ANSI mode, whatever the text."""
    texts = random_texts("0123456789+-. \teE", 6, 4000) + random_texts("0123456789.", 13, 1000)
    parsed = values(lambda c: parse_int(F.col(c)), texts)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert parsed == values(lambda c: F.col(c).cast("int"), texts)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_income_level_equals_the_rule(values):
    incomes = list(range(-130, 620))
    expected = {i: i // 20 + 1 if i < 500 else 25 for i in incomes}
    assert values(lambda c: income_level(F.col(c)), incomes, "int") == expected


def test_normalize_tract_equals_the_rule(values):
    texts = random_texts("0123456789.N", 12, 2000)
    expected = {t: t if len(t) == 11 else "06037" + t.replace(".", "") for t in texts}
    assert values(lambda c: normalize_tract(F.col(c), F.lit("06037")), texts) == expected


def test_parse_date_equals_the_calendar(values):
    """Any one- or two-digit month and day: the date if there is one, else null."""
    pick = random.Random(5)
    texts = {
        f"{pick.randint(0, 14)}/{pick.randint(0, 33)}/{pick.randint(1990, 2030)}"
        for _ in range(2000)
    }

    def expected(text):
        month, date, year = map(int, text.split("/"))
        try:
            return day(year, month, date)
        except ValueError:
            return None

    found = values(lambda c: parse_date(F.col(c), "MM/dd/yyyy HH:mm:ss"), sorted(texts))
    assert found == {text: expected(text) for text in texts}
