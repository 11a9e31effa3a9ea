import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions import dates, numbers, text

KEYS = ["tampa", "  TAMPA ", " Key West ", "\t\x1cST. CLOUD\r\n", "", " ", None, "a  b", "　x\u0085"]


def apply(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_strip_matches_python_for_all_whitespace(spark):
    assert apply(spark, KEYS, text.strip) == [k if k is None else k.strip() for k in KEYS]


def test_one_sided_strips(spark):
    values = ["  a ", None, "\ta ", " "]
    assert apply(spark, values, text.lstrip) == ["a ", None, "\ta ", ""]
    assert apply(spark, values, text.rstrip) == ["  a", None, "\ta", ""]


def test_money(spark):
    values = ["$1,234.50", "$$2", "7 ", None, "-3.25"]
    assert apply(spark, values, lambda c: text.parse_money(c).cast("double")) == [1234.5, 2.0, 7.0, None, -3.25]


@pytest.mark.parametrize("bad", ["$", "12x", "--"])
def test_bad_money_fails(spark, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        apply(spark, [bad], text.parse_money)


def test_double_strict_and_lenient(spark):
    assert apply(spark, ["1.5", "x", None], lambda c: numbers.to_double(c, strict=False)) == [1.5, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, ["x"], numbers.to_double)


def test_tokens(spark):
    values = ["St. Lucie County", "Tampa", "", None, "1 Main St, Ocala, FL 34470-1234"]
    assert apply(spark, values, lambda c: text.first_token(c)) == ["St.", "Tampa", "", None, "1"]
    assert apply(spark, values, lambda c: text.last_token(c)) == [v if v is None else v.split(",")[-1] for v in values]


def test_zip_pattern(spark):
    values = ["FL 34470-1234", "02134", "1234", None, "FL 123456", ""]
    want = pd.Series(values, dtype=object).str.extract(r"(\d{5})-?\d*")[0]
    assert apply(spark, values, text.extract_zip) == [None if v is None or v != v else v for v in want]


def test_replacement_is_one_pass_and_whole_cell(spark):
    pairs = {"a": "b", "b": "c"}
    assert apply(spark, ["a", "b", "ab", None], lambda c: text.replace_each(c, pairs)) == ["b", "c", "ab", None]


def test_undefined_takes_null_and_one_blank_only(spark):
    assert apply(spark, [None, " ", "  ", "x"], text.undefined_if_blank) == ["UNDEFINED", "UNDEFINED", "  ", "x"]


def test_windows_1252(spark):
    raw = bytes(b for b in range(0x20, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    assert apply(spark, [raw.decode("latin-1")], text.cp1252_from_latin1) == [raw.decode("cp1252")]


def test_numbers(spark):
    assert apply(spark, [1, 2, 3, None], numbers.ceil_half, "bigint") == [1, 1, 2, None]
    assert apply(spark, [1, -3, 2**40 + 1], numbers.ceil_half, "bigint") == [math.ceil(v / 2) for v in (1, -3, 2**40 + 1)]
    assert apply(spark, ["Y", "N", None], numbers.flag_to_int) == [1, None, None]
    assert apply(spark, ["--", "2.5", None], numbers.sentinel_to_zero) == [0.0, 2.5, None]


def test_annual_pay(spark):
    rows = [(1, "M", 100.0, 0.5), (2, "B", 100.0, 0.5), (1, "H", 100.0, 0.5), (4, "M", 10.0, 0.5), (5, None, 10.0, None), (1, None, 1.0, 1.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t int, code string, rate double, fte double")
    pay = numbers.annualize_hourly(F.col("rate"), F.col("fte"), F.col("t"), F.col("code"))
    assert [r[0] for r in df.orderBy("i").select(pay).collect()] == [1200.0, 2600.0, None, 10000.0, None, None]


@pytest.mark.parametrize("fy", ["18-19", "19-20"])
@pytest.mark.parametrize("periods", [None, 365])
def test_calendar_matches_evenly_spaced_stamps(spark, fy, periods):
    first, last = dates.fiscal_bounds(fy)
    stamps = pd.date_range(first, last, periods=periods) if periods else pd.date_range(first, last, freq="D")
    want = sorted({s.date() for s in stamps})
    assert sorted(r[0] for r in dates.fiscal_days(spark, fy, periods).collect()) == want
    # the closed-form test agrees with the calendar for every day around it
    days = [first + dt.timedelta(d) for d in range(-3, (last - first).days + 4)]
    df = spark.createDataFrame([(d, None) for d in days] + [(None, d) for d in days] + [(None, None)], "s date, e date")
    hit = df.filter(dates.endpoint_in_range(F.col("s"), F.col("e"), first, last, periods))
    assert sorted(r[0] or r[1] for r in hit.collect()) == sorted(want * 2)


def test_spanning_certificate_is_not_active(spark):
    first, last = dates.fiscal_bounds("18-19")
    df = spark.createDataFrame([(dt.date(2017, 1, 1), dt.date(2020, 1, 1))], "s date, e date")
    assert df.filter(dates.endpoint_in_range(F.col("s"), F.col("e"), first, last)).count() == 0


def test_fiscal_label(spark):
    values = [dt.date(2018, 6, 30), dt.date(2018, 7, 1), dt.date(2000, 1, 1), dt.date(1999, 7, 1), None]
    assert apply(spark, values, dates.fiscal_label, "date") == ["17-18", "18-19", "99-00", "99-00", None]
