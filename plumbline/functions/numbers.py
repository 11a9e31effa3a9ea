"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pay periods per year by pay code, and full-time hours per year.
PAY_PERIODS = {"M": 12, "B": 26}
FULL_TIME_HOURS = 2000
HOURLY_TYPES = (4, 5)


def to_double(c: Column, strict: bool = True) -> Column:
    """Cast to double. Bad text fails the job, or gives null if not strict."""
    return c.cast("double") if strict else c.try_cast("double")


def to_string(c: Column) -> Column:
    return c.cast("string")


def ceil_half(c: Column) -> Column:
    return F.ceil(c / 2).cast("bigint")


def annualize(rate: Column, code: Column) -> Column:
    """Yearly pay from the rate per pay period; other codes give null."""
    out = F.lit(None)
    for name, periods in PAY_PERIODS.items():
        out = F.when(code == name, rate * F.lit(periods)).otherwise(out)
    return out


def annualize_hourly(rate: Column, fte: Column, emp_type: Column, code: Column) -> Column:
    """Yearly pay of hourly staff (rate, FTE, hours), the pay-period rule for
    all others."""
    hourly = emp_type.cast("int").isin(*HOURLY_TYPES)
    return F.when(hourly, rate * fte * F.lit(FULL_TIME_HOURS)).otherwise(annualize(rate, code))


def flag_to_int(c: Column, flag: str = "Y") -> Column:
    """1 for the flag; anything else counts as missing."""
    return F.when(c == flag, F.lit(1))


def sentinel_to_zero(c: Column, sentinel: str = "--", as_type: str = "double") -> Column:
    return F.when(c == sentinel, F.lit("0")).otherwise(c).cast(as_type)


def add_all(*cols: Column) -> Column:
    """Sum across columns; null if any operand is null."""
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out
