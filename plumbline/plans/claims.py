"""Health claims: four sheets (medical and pharmacy, retirees and active)."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import MONEY, strip
from plumbline.operators.joins import HOT_ROWS, Side, by_key_class, outer

SHEETS = ("medical_retiree", "medical_active", "pharmacy_retiree", "pharmacy_active")
TOTALS = ("medical_claims", "pharmacy_claims", "total_claims")


def sheet_total(sheet: DataFrame, name: str, fill_null: bool = False) -> DataFrame:
    """Zip and enrollee plus dependents; null if either is, unless filled."""
    if fill_null:
        sheet = sheet.na.fill(0)
    total = F.col("enrollee").cast(MONEY) + F.col("dependents").cast(MONEY)
    return sheet.select("zip", total.alias(name))


def combine_claims(
    medical_retiree: DataFrame, medical_active: DataFrame, pharmacy_retiree: DataFrame, pharmacy_active: DataFrame,
    *, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per match of the four sheets on zip, with staged totals.

    A total is null where a part is null, so a zip on one sheet only has no
    total. Zips repeated on a sheet repeat their matches. The sheets are raw,
    so the null zip or another may be hot: hot zips are counted once over all
    four, and composed apart from the rest.
    """
    def combine(sides: list[Side]) -> Side:
        mr, me, pr, pe = sides
        medical, pharmacy = outer(mr, me, "zip"), outer(pr, pe, "zip")
        medical = replace(medical, df=medical.df.withColumn("medical_claims", F.col("me") + F.col("mr")))
        pharmacy = replace(pharmacy, df=pharmacy.df.withColumn("pharmacy_claims", F.col("pe") + F.col("pr")))
        return outer(medical, pharmacy, "zip")

    sheets = {"mr": medical_retiree, "me": medical_active, "pr": pharmacy_retiree, "pe": pharmacy_active}
    joined = by_key_class([sheet_total(sheet, name) for name, sheet in sheets.items()], "zip", combine, hot_rows)
    return joined.withColumns(
        {
            "total_claims": F.col("medical_claims") + F.col("pharmacy_claims"),
            "employee_claims": F.col("me") + F.col("pe"),
        }
    )


def claims_by_zip(sheets: dict[str, DataFrame], *, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Sums of :func:`combine_claims` per zip, without making its rows.

    The joined rows of a zip are all combinations of its rows on the four
    sheets, so their sums follow from each sheet's sum, non-null count and
    row count. One shuffle of partial aggregates replaces three full outer
    joins, and a zip with many rows per sheet does not multiply.

    ``sheets`` maps the names in SHEETS to frames of zip, enrollee, dependents
    and the extra keys. Null zips form a group of their own.
    """
    keys = [*extra_keys, "zip"]
    total = F.col("enrollee").cast(MONEY) + F.col("dependents").cast(MONEY)
    tagged = reduce(
        DataFrame.unionByName,
        [sheets[name].select(*keys, total.alias("v"), F.lit(i).alias("s")) for i, name in enumerate(SHEETS)],
    )
    zero = F.lit(0).cast(MONEY)
    per_zip = tagged.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("s") == i, F.col("v"))), zero).alias(f"sum{i}") for i in range(4)],
        *[F.count(F.when(F.col("s") == i, F.col("v"))).alias(f"vals{i}") for i in range(4)],
        *[F.greatest(F.count_if(F.col("s") == i), F.lit(1)).alias(f"rows{i}") for i in range(4)],
    )
    c = F.col
    medical = c("sum0") * c("vals1") + c("sum1") * c("vals0")
    pharmacy = c("sum2") * c("vals3") + c("sum3") * c("vals2")
    return per_zip.select(
        *keys,
        (medical * (c("rows2") * c("rows3"))).alias("medical_claims"),
        (pharmacy * (c("rows0") * c("rows1"))).alias("pharmacy_claims"),
        (medical * (c("vals2") * c("vals3")) + pharmacy * (c("vals0") * c("vals1"))).alias("total_claims"),
    )


def strip_zip(df: DataFrame) -> DataFrame:
    return df.withColumn("zip", strip(F.col("zip")))
