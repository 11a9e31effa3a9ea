"""String expressions for location keys and money columns."""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the strip rule removes: all Unicode whitespace. Spark's
# trim alone removes blanks only.
WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())

# Amounts are kept to ten decimals, so that parts of a cent add up; sums get ten
# more digits. Nothing is rounded to cents on the way.
MONEY = "decimal(28,10)"


def upper_key(c: Column) -> Column:
    return F.upper(c)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def lstrip(c: Column, chars: str = " ") -> Column:
    return F.ltrim(c, F.lit(chars))


def rstrip(c: Column, chars: str = " ") -> Column:
    return F.rtrim(c, F.lit(chars))


def strip_currency(c: Column, symbol: str = "$") -> Column:
    """Remove every leading currency sign."""
    return F.ltrim(c, F.lit(symbol))


def strip_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def parse_money(c: Column, symbol: str = "$", as_type: str = MONEY) -> Column:
    """``$1,234.50`` to a number; text that is no number fails the job."""
    return F.btrim(strip_commas(strip_currency(c, symbol)), F.lit(" ")).cast(as_type)


def append_suffix(c: Column, suffix: str) -> Column:
    """Null stays null."""
    return F.concat(c, F.lit(suffix))


def first_token(c: Column, sep: str = " ") -> Column:
    return F.substring_index(c, sep, 1)


def last_token(c: Column, sep: str = ",") -> Column:
    return F.substring_index(c, sep, -1)


def extract_zip(c: Column) -> Column:
    """First run of five digits; null when there is none."""
    return F.nullif(F.regexp_extract(c, r"(\d{5})-?\d*", 1), F.lit(""))


def replace_each(c: Column, pairs: dict[str, str]) -> Column:
    """Whole-value replacement in one pass; values not listed stay."""
    if not pairs:
        return c
    items = list(pairs.items())
    first = F.when(c == F.lit(items[0][0]), F.lit(items[0][1]))
    return reduce(lambda w, kv: w.when(c == F.lit(kv[0]), F.lit(kv[1])), items[1:], first).otherwise(c)


def undefined_if_blank(c: Column, label: str = "UNDEFINED") -> Column:
    """Null or a single blank becomes ``label``."""
    return F.when(c.isNull() | (c == " "), F.lit(label)).otherwise(c)


def cp1252_text(text: str) -> str:
    """As :func:`cp1252_from_latin1`, for a string."""
    return "".join(bytes([ord(c)]).decode("cp1252", "replace") if 0x80 <= ord(c) < 0xA0 else c for c in text)


def cp1252_from_latin1(c: Column) -> Column:
    """Windows-1252 text that was decoded as ISO-8859-1."""
    wrong, right = [], []
    for code in range(0x80, 0xA0):
        try:
            right.append(bytes([code]).decode("cp1252"))
        except UnicodeDecodeError:
            continue
        wrong.append(chr(code))
    return F.translate(c, "".join(wrong), "".join(right))
