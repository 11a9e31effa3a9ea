"""Totals outside the home state, one row per fiscal year.

All years run in one pass: rows carry their year and are grouped by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import MONEY, strip_commas
from plumbline.operators.aggregates import Spec, aggregate, total_row
from plumbline.operators.clean import filter_ne
from plumbline.operators.joins import anti_join, attach_metric
from plumbline.operators.unions import union_years
from plumbline.plans import claims as claim_sheets
from plumbline.plans.fixed import RETIREE_OUT_OF_STATE_TO, RETIREE_OUT_OF_STATE_YEAR, YEARS
from plumbline.sources.ordinals import slice_labels
from plumbline.sources.tables import YEAR


def fy_spine(spark: SparkSession, years: tuple[str, ...] = YEARS) -> DataFrame:
    """One row per label, as a constant the planner knows the size of."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, years))).alias(YEAR))


def _per_year(df: DataFrame, spec: Spec, years: DataFrame) -> DataFrame:
    """Totals per year; a year without rows has totals of 0, as any sum has."""
    return years.join(aggregate(df, [YEAR], spec), YEAR, "left").na.fill(0)


def claims_outside(sheets: dict[str, DataFrame], zips: DataFrame, years: DataFrame) -> DataFrame:
    """sheets: fy, zip, enrollee, dependents. Zips the lookup lacks, the null
    zip among them."""
    per_zip = claim_sheets.strip_zip(claim_sheets.claims_by_zip(sheets, extra_keys=(YEAR,)))
    names = {
        "non_home_medical_claims": ("medical_claims", "exact"),
        "non_home_pharma_claims": ("pharmacy_claims", "exact"),
        "non_home_claims": ("total_claims", "exact"),
    }
    return _per_year(anti_join(per_zip, zips, "zip"), names, years)


def spend_outside(fact: DataFrame, years: DataFrame, *, home_state: str) -> DataFrame:
    """fact: fy, state, vendor, invoice, amount (text). A missing state is
    outside."""
    df = filter_ne(fact, "state", home_state).withColumn("amount", strip_commas(F.col("amount")).cast(MONEY))
    return _per_year(
        df,
        {
            "non_home_marketplace_spend": ("amount", "money"),
            "non_home_vendors": ("vendor", "nunique"),
            "invoices": ("invoice", "nunique"),
        },
        years,
    )


def retirees_outside(
    current: DataFrame, history: DataFrame, *, order: list[str], current_year: str = "21-22"
) -> DataFrame:
    """current and history: payment, payees; history also fiscal_year. The
    out-of-state rows are the first ones of each file."""
    spec = {"benefits_paid_to_non_home_retirees": ("payment", "money"), "non_home_payees": ("payees", "sum")}
    head = slice_labels(current, 0, RETIREE_OUT_OF_STATE_TO[current_year], order)
    rows = [total_row(head, spec, current_year)]
    label = F.lit(None).cast("string")
    for year, fiscal in RETIREE_OUT_OF_STATE_YEAR.items():
        label = F.when(F.col("fiscal_year") == fiscal, F.lit(year)).otherwise(label)
    # one cut serves all earlier years
    cuts = {RETIREE_OUT_OF_STATE_TO[y] for y in RETIREE_OUT_OF_STATE_YEAR}
    for cut in cuts:
        years = tuple(y for y in RETIREE_OUT_OF_STATE_YEAR if RETIREE_OUT_OF_STATE_TO[y] == cut)
        top = slice_labels(history, 0, cut, order).withColumn(YEAR, label)
        rows.append(_per_year(top, spec, fy_spine(history.sparkSession, years)))
    return union_years(rows)


def summary(years: DataFrame, *metrics: DataFrame) -> DataFrame:
    """Year labels with the totals of each source."""
    for metric in metrics:
        years = attach_metric(years, metric, YEAR)
    return years
