"""Scalar expressions: NULLs, sentinels, signs and types."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions import (
    Dating,
    age_at_first_contact,
    as_midnight,
    days_between,
    in_codes,
    join_text,
    known,
    lookback,
    prefer_known,
    starts_with_any,
    whole_weeks,
    within,
    yes_no,
)

D = datetime.date
ROW = "a string, b string, d date, e date, n int, x boolean"


def value(spark, expression, a=None, b=None, d=None, e=None, n=None, x=None):
    return spark.createDataFrame([(a, b, d, e, n, x)], ROW).select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    "a, b, joined", [("Rua X", "10", "Rua X, 10"), (None, "10", ", 10"), ("Rua X", None, "Rua X, "), (None, None, ", ")]
)
def test_join_text(spark, a, b, joined):
    assert value(spark, join_text(F.col("a"), F.col("b")), a, b) == joined


@pytest.mark.parametrize("a, b, chosen", [("x", "y", "x"), ("-", "y", "y"), (None, "y", "y"), ("-", None, None)])
def test_prefer_known(spark, a, b, chosen):
    assert value(spark, prefer_known(F.col("a"), "-", F.col("b")), a, b) == chosen


@pytest.mark.parametrize("a, chosen", [("x", "x"), (", ", None), (None, None)])
def test_known(spark, a, chosen):
    assert value(spark, known(F.col("a"), ", "), a) == chosen


@pytest.mark.parametrize("x, label", [(True, "Sim"), (False, "Não"), (None, "Não")])
def test_yes_no(spark, x, label):
    assert value(spark, yes_no(F.col("x")), x=x) == label


@pytest.mark.parametrize("days, weeks", [(0, 0), (6, 0), (7, 1), (13, 1), (-6, 0), (-7, -1), (-10, -1), (-60, -8)])
def test_whole_weeks_cut_towards_zero(spark, days, weeks):
    day = D(2024, 2, 29)
    assert value(spark, whole_weeks(F.col("e"), F.col("d")), d=day, e=day + datetime.timedelta(days)) == weeks
    assert value(spark, days_between(F.col("e"), F.col("d")), d=day, e=day + datetime.timedelta(days)) == days


def test_lookback_includes_its_first_day(spark):
    as_of = F.lit(D(2024, 6, 30))
    assert value(spark, lookback(F.col("d"), as_of, 30), d=D(2024, 5, 31)) is True
    assert value(spark, lookback(F.col("d"), as_of, 30), d=D(2024, 5, 30)) is False
    assert value(spark, lookback(F.col("d"), as_of, 30)) is None


def test_within_promotes_dates_to_midnight(spark):
    inside = within(F.col("d"), F.col("e"), as_midnight(F.date_add("e", 10)))
    assert value(spark, inside, d=D(2024, 1, 11), e=D(2024, 1, 1)) is True
    assert value(spark, inside, d=D(2024, 1, 12), e=D(2024, 1, 1)) is False
    assert value(spark, inside, d=D(2024, 1, 12)) is None


def test_codes(spark):
    assert value(spark, starts_with_any(F.col("a"), ["2231", "2235"]), "223505") is True
    assert value(spark, starts_with_any(F.col("a"), ["2231", "2235"]), "12231") is False
    assert value(spark, in_codes("a", ["O24", "it's", "back\\slash"]), "it's") is True
    assert value(spark, in_codes("a", ["O24", "it's", "back\\slash"]), "back\\slash") is True
    assert value(spark, in_codes("a", ["O24"]), "O245") is False
    assert value(spark, in_codes("a", ["O24"])) is None


RULE = Dating()


@pytest.mark.parametrize(
    "reported, weeks, start",
    [
        (D(2024, 1, 1), 5, D(2024, 1, 1)),
        (D(3000, 12, 31), 5, D(2024, 5, 27)),
        (D(3000, 12, 31), None, None),
        (None, 5, D(2024, 5, 27)),
        (None, None, None),
    ],
)
def test_start(spark, reported, weeks, start):
    expression = RULE.start(F.col("d"), F.year("d"), F.col("e"), F.col("n"))
    assert value(spark, expression, d=reported, e=D(2024, 7, 1), n=weeks) == start


def test_due_is_a_zoneless_midnight(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),)], "d date").select(RULE.due(F.col("d")).alias("due"))
    assert df.schema["due"].dataType == T.TimestampNTZType()
    assert df.first().due == datetime.datetime(2024, 10, 21)


@pytest.mark.parametrize(
    "start, weeks, age",
    [
        (D(2024, 1, 1), 3, 4), (D(2024, 2, 10), 3, -1), (D(3000, 12, 31), 3, 3), (D(3000, 5, 1), 3, 3), (None, 3, 3),
        (None, None, None),
    ],
)
def test_age_at_first_contact(spark, start, weeks, age):
    expression = age_at_first_contact(F.col("d"), F.col("e"), F.col("n"))
    assert value(spark, expression, d=start, e=D(2024, 2, 1), n=weeks) == age
