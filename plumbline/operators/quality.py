"""Checks on cleaned data: the single ones, and a report on a year's table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.aggregates import control_total, profile_nulls, reconcile, value_counts
from plumbline.operators.joins import audit_unique, unmatched_keys
from plumbline.operators.unions import union_years

__all__ = [
    "audit_unique", "control_total", "key_report", "null_report", "profile_nulls", "reconcile", "reports", "totals_report",
    "unmatched_keys", "value_counts",
]


def key_report(rows: DataFrame, sources: list[str], source: str, spine: DataFrame, key: str) -> DataFrame:
    """(check, subject, value) for metric rows of several sources, told apart by
    the column ``source``: ``repeated keys``, rows beyond one per key, which
    would repeat the spine, and ``keys off the spine``, which a left join
    loses. One pass for all sources; one without rows has zeros."""
    per_key = rows.groupBy(source, key).agg(F.count("*").alias("n"))
    on_spine = spine.select(F.col(key).alias("_skey")).distinct().withColumn("_on", F.lit(True))
    marked = per_key.join(on_spine, F.col(key).eqNullSafe(F.col("_skey")), "left")
    per_source = marked.groupBy(source).agg(
        F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1)).alias("repeated keys"), F.count_if(F.col("_on").isNull()).alias("keys off the spine")
    )
    checks = ["repeated keys", "keys off the spine"]
    listed = rows.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, sources))).alias(source))
    every = listed.join(per_source, source, "left").select(source, *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in checks])
    return every.unpivot([source], checks, "check", "value").select("check", F.col(source).alias("subject"), "value")


def totals_report(df: DataFrame, check: str, columns: dict[str, str]) -> DataFrame | None:
    """(check, subject, value): the sum of each number column, null for one
    without values, under the name ``columns`` gives it."""
    names = {c: n for c, n in columns.items() if isinstance(df.schema[c].dataType, T.NumericType)}
    if not names:
        return None
    sums = df.agg(*[F.sum(f"`{c}`").cast("double").alias(n) for c, n in names.items()])
    return sums.unpivot([], list(names.values()), "subject", "value").select(F.lit(check).alias("check"), "subject", "value")


def null_report(df: DataFrame) -> DataFrame:
    percent = F.col("percent").alias("value")
    return profile_nulls(df).select(F.lit("percent null").alias("check"), F.col("column_name").alias("subject"), percent)


def reports(parts: list[DataFrame | None]) -> DataFrame:
    return union_years([p for p in parts if p is not None])
