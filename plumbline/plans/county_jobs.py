"""Metrics per county. Each job returns ``county`` and its metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import add_all
from plumbline.functions.text import MONEY, strip_currency
from plumbline.operators.aggregates import aggregate
from plumbline.operators.clean import regexp_replace_all
from plumbline.plans.cleaning import Refs, apply_steps
from plumbline.plans.fixed import ERATE_COUNTIES, STEPS, TOWER_COUNTIES

DISBURSEMENT_PARTS = ("wireless", "nonwireless", "prepaid_wireless", "supplemental", "special")


def grants(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: county, final_award."""
    df = apply_steps(fact, "county", STEPS["grants"][year][0], refs, present=True)
    return aggregate(df, ["county"], {"grants_awarded": ("final_award", "money")}, present=True)


def disbursements(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: county and the five parts, or ``total`` in 18-19."""
    if year == "18-19":
        paid = F.col("total").cast(MONEY)
    else:
        paid = add_all(*[F.col(p).cast(MONEY) for p in DISBURSEMENT_PARTS])
    df = apply_steps(fact.select("county", paid.alias("paid")), "county", STEPS["disbursements"][year][0], refs, present=True)
    return aggregate(df, ["county"], {"e911_disbursements": ("paid", "money")}, present=True)


def erate(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: county, authorized (text such as ``$1,234.50``). Commas leave
    every text column, the county included."""
    df = fact.select("county", strip_currency(F.col("authorized")).alias("amount"))
    df = apply_steps(df, "county", STEPS["erate"][year][0], refs, inline=ERATE_COUNTIES)
    df = regexp_replace_all(df, ",", "").withColumn("amount", F.btrim("amount", F.lit(" ")).cast(MONEY))
    return aggregate(df, ["county"], {"erate_disbursements": ("amount", "money")})


def call_centers(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: county, center."""
    df = apply_steps(fact.select("county", "center"), "county", STEPS["call_centers"][year][0], refs, present=True)
    return aggregate(df, ["county"], {"e911_circuits": ("center", "count")}, present=True)


def towers(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: county, tower. The suffix and the spelling map come after the
    group-by, so two spellings of a county stay two rows."""
    before, after = STEPS["towers"][year]
    df = apply_steps(fact.select("county", "tower"), "county", before, refs, inline=TOWER_COUNTIES, present=True)
    out = aggregate(df, ["county"], {"radio_towers": ("tower", "count")}, present=True)
    return apply_steps(out, "county", after, refs)
