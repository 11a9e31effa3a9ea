"""Unions of years and of summary rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_years(dfs: list[DataFrame]) -> DataFrame:
    """Union by column name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
