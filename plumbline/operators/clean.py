"""Projections, filters, null rules, replacement and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import text
from plumbline.operators.lookups import Lookup, lookup_of
from plumbline.sources.tables import YEAR


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Names that are not there are ignored."""
    return df.withColumnsRenamed(names)


def drop_if_all_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the columns only if every one of them is there."""
    return df.drop(*columns) if set(columns) <= set(df.columns) else df


def filter_ne(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows that differ from ``value``; null rows differ."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def exclude_values(df: DataFrame, column: str, values: DataFrame | Lookup | list) -> DataFrame:
    """Rows whose value is not listed; null rows stay.

    ``values`` is a short list, a frame whose first column holds them, or the
    lookup of one.
    """
    if isinstance(values, DataFrame):
        values = lookup_of(values.select(f"`{values.columns[0]}`"))
    if isinstance(values, Lookup):
        if values.constant:
            return df.filter(~values.has(F.col(f"`{column}`")))
        return df.join(values.frame.select(F.col("key").alias("_listed")), F.col(column) == F.col("_listed"), "left_anti")
    if not values:
        return df
    return df.filter(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def replace_values(df: DataFrame, columns: list[str], mapping: DataFrame | Lookup) -> DataFrame:
    """Whole-value replacement in text columns from a frame of (wrong, right),
    or its lookup, in one pass. A null ``right`` replaces nothing.

    ``wrong`` must be unique, as :func:`read_mapping` makes it. A small map is
    looked up in one projection for all columns; a large one is joined once
    per column.
    """
    lookup = mapping if isinstance(mapping, Lookup) else lookup_of(mapping)
    if lookup.constant:
        return df.withColumns({c: lookup.replace(F.col(f"`{c}`")) for c in columns})
    pairs = lookup.frame.select(F.col("key").alias("_wrong"), F.col("value").alias("_right"))
    names = df.columns
    for column in columns:
        fixed = F.coalesce(F.col("_right"), F.col(column)).alias(column)
        joined = df.join(pairs, F.col(column) == F.col("_wrong"), "left")
        df = joined.select(*[fixed if c == column else F.col(f"`{c}`") for c in names])
    return df


def replace_literals(df: DataFrame, columns: list[str], pairs: dict[str, str]) -> DataFrame:
    return df.withColumns({c: text.replace_each(F.col(c), pairs) for c in columns})


def regexp_replace_all(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Regex replacement in every text column."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.regexp_replace(c, pattern, replacement) for c in strings})


def undefined_bucket(df: DataFrame, column: str, label: str = "UNDEFINED") -> DataFrame:
    return df.withColumn(column, text.undefined_if_blank(F.col(column), label))


def drop_null(df: DataFrame, columns: list[str], how: str = "any") -> DataFrame:
    return df.na.drop(how=how, subset=columns)


def fill_null(df: DataFrame, value: object, columns: list[str] | None = None) -> DataFrame:
    return df.na.fill(value, subset=columns)


def with_fy(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn(YEAR, F.lit(label))


def flag_then_filter(df: DataFrame, condition: Column, flag: str = "indicator") -> DataFrame:
    """Mark rows '1' or '0' and keep the marked ones, mark included."""
    return df.withColumn(flag, F.when(condition, F.lit("1")).otherwise(F.lit("0"))).filter(F.col(flag) == "1")


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in ``order``; null keys count as equal.

    A partial aggregate leaves one row per key and task before the shuffle,
    so a hot key cannot fill one task.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = df.groupBy(*keys).agg(F.min_by(whole, F.struct(*order)).alias("_row"))
    return first.select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def first_rows(df: DataFrame, keys: list[str], order: list[str], taken: dict[str, tuple[Column | None, dict[str, Column]]]) -> DataFrame:
    """Per key and name of ``taken`` the given columns, as a struct, of the
    first row in ``order`` that meets the condition (None: any row); null if
    none does. One pass serves all names, and only those columns are moved."""
    at = F.struct(*order)
    firsts = [
        F.min_by(F.struct(*[c.alias(n) for n, c in columns.items()]), at if met is None else F.when(met, at)).alias(name)
        for name, (met, columns) in taken.items()
    ]
    return df.groupBy(*keys).agg(*firsts)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
