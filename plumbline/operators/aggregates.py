"""Grouped and whole-table aggregates.

Groups with a null key are left out, the sum of nothing but nulls is 0, and
counts ignore nulls.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import MONEY
from plumbline.sources.tables import YEAR

QUANTITY = "decimal(24,6)"
# output name -> (source column, function)
Spec = dict[str, tuple[str, str]]


def _agg(source: str, fn: str, order: list[str] | None) -> Column:
    c = F.col(f"`{source}`")
    if fn == "sum":
        return F.coalesce(F.sum(c), F.lit(0))
    if fn == "money":
        # exact in any task order; double only at the end
        return F.coalesce(F.sum(c.cast(MONEY)), F.lit(0)).cast("double")
    if fn == "quantity":
        return F.coalesce(F.sum(c.cast(QUANTITY)), F.lit(0)).cast("double")
    if fn == "exact":
        # sums that are decimals already, too wide for the money type
        return F.coalesce(F.sum(c), F.lit(0)).cast("double")
    if fn == "count":
        return F.count(c)
    if fn == "nunique":
        return F.count_distinct(c)
    if fn == "first":
        if not order:
            raise ValueError("'first' needs the row order")
        # min_by skips rows whose order value is null
        return F.min_by(c, F.when(c.isNotNull(), F.struct(*order)))
    raise ValueError(f"unknown aggregate {fn!r}")


def _exprs(spec: Spec, order: list[str] | None = None) -> list[Column]:
    return [_agg(source, fn, order).alias(name) for name, (source, fn) in spec.items()]


def aggregate(
    df: DataFrame,
    keys: list[str] | dict[str, Column],
    spec: Spec,
    *,
    order: list[str] | None = None,
    present: bool = False,
) -> DataFrame:
    """Group by columns, or by ``{name: expression}``, and apply ``spec``.

    ``present`` says that no key is null, which spares a filter that would
    work the key expressions out a second time.
    """
    if isinstance(keys, dict):
        sources = {source for source, _ in spec.values()} | set(order or [])
        df = df.select(*[c.alias(n) for n, c in keys.items()], *[F.col(f"`{s}`") for s in sources - set(keys)])
    names = list(keys)
    if not present:
        df = df.filter(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]))
    return df.groupBy(*names).agg(*_exprs(spec, order))


def per_group(df: DataFrame, keys: list[str], sums: list[Column]) -> DataFrame:
    """``sums`` per group of the keys; null keys stay. What is made of the keys
    afterwards is made once per group: the optimizer takes a filter on a key
    through a group-by to every row below it, but not one on a key that hangs
    on the number of the group's rows. No group is empty, so the key is the same.
    """
    groups = df.groupBy(*keys).agg(F.count("*").alias("_rows"), *sums)
    return groups.withColumns({k: F.when(F.col("_rows") > 0, F.col(k)) for k in keys}).drop("_rows")


def pre_sum(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Exact sums per key ahead of a lookup on that key, so that the lookup
    sees one row per key. Null keys and null sums stay."""
    return per_group(df, keys, [F.sum(c).alias(c) for c in columns])


def pre_aggregate(df: DataFrame, key: str, spec: Spec) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``spec`` in two steps: rows are summed per key as it is and per values to
    be counted apart, and the function returned aggregates these by the key that
    was made of it. ``spec`` may not hold 'first'. Text that is no number fails
    the job only if its row is still there then: texts are read and those that
    cannot be are counted."""
    partial, again, unread = [], {}, {}
    counted = list(dict.fromkeys(source for source, fn in spec.values() if fn == "nunique"))
    for i, (name, (source, fn)) in enumerate(spec.items()):
        c = F.col(f"`{source}`")
        if fn == "nunique":
            again[name] = (source, fn)
            continue
        kind = {"money": MONEY, "quantity": QUANTITY}.get(fn)
        if kind and isinstance(df.schema[source].dataType, T.StringType):
            number = c.try_cast(kind)
            partial.append(F.count_if(c.isNotNull() & number.isNull()).alias(f"_unread{i}"))
            unread[f"_sum{i}"] = (f"_unread{i}", F.lit(f"{source}: text that is no number"))
        else:
            number = c.cast(kind) if kind else c
        partial.append((F.count(c) if fn == "count" else F.sum(number)).alias(f"_sum{i}"))
        again[name] = (f"_sum{i}", "sum" if fn in ("sum", "count") else "exact")
    groups = per_group(df, [key, *counted], partial)
    # the sum of decimal sums would be wider than that of the rows
    types = {n: groups.schema[s].dataType for n, (s, fn) in again.items() if fn == "sum"}

    def finish(cleaned: DataFrame) -> DataFrame:
        read = {s: F.when(F.col(n) > 0, F.raise_error(told)).otherwise(F.col(s)) for s, (n, told) in unread.items()}
        out = aggregate(cleaned.withColumns(read) if read else cleaned, [key], again, present=True)
        return out.withColumns({n: F.col(f"`{n}`").cast(t) for n, t in types.items() if out.schema[n].dataType != t})

    return groups, finish


def metric_sum(df: DataFrame, key: str, columns: list[str], *, money: bool = True) -> DataFrame:
    return aggregate(df, [key], {c: (c, "money" if money else "sum") for c in columns})


def metric_count(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    return aggregate(df, [key], {name: (column, "count")})


def metric_nunique(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    return aggregate(df, [key], {name: (column, "nunique")})


def metric_first(df: DataFrame, key: str, column: str, name: str, order: list[str]) -> DataFrame:
    """First non-null value per key in ``order``."""
    return aggregate(df, [key], {name: (column, "first")}, order=order)


def rollup_via(
    fact: DataFrame, dim: DataFrame, fine: str, dim_key: str, coarse: str, spec: Spec
) -> DataFrame:
    """Group by ``fine``, look its ``coarse`` key up, group again.

    The lookup sees one row per fine key. ``spec`` may only hold sums.
    """
    per_fine = aggregate(fact, [fine], spec)
    keys = dim.select(F.col(dim_key).alias(fine), coarse)
    again = {name: (name, fn) for name, (_, fn) in spec.items()}
    return aggregate(per_fine.join(keys, fine, "left"), [coarse], again)


def total_row(df: DataFrame, spec: Spec, label: str) -> DataFrame:
    """One row for the whole table, labelled with its fiscal year."""
    return df.agg(*_exprs(spec)).withColumn(YEAR, F.lit(label))


def control_total(df: DataFrame, spec: Spec) -> DataFrame:
    return df.agg(*_exprs(spec))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequencies of non-null values, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), column)


def profile_nulls(df: DataFrame) -> DataFrame:
    """Per column: number and percentage of nulls, and the type. One pass. The
    percentage of an empty table is null."""
    names = df.columns
    nulls = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(names)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_n{i}").alias("total"),
                (F.try_divide(f"_n{i}", "_rows") * 100).alias("percent"),
                F.lit(df.schema[c].dataType.simpleString()).alias("type"),
            )
            for i, c in enumerate(names)
        ]
    )
    return nulls.select(F.inline(rows))


def reconcile(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """Control totals of two stages side by side, with their difference. Totals
    are subtracted as exact decimals and become doubles once, at the end."""
    def totals(df: DataFrame, stage: str) -> DataFrame:
        sums = [F.coalesce(F.sum(F.col(f"`{c}`").cast(MONEY)), F.lit(0)).cast("decimal(38,10)").alias(c) for c in columns]
        return df.agg(*sums).withColumn("_stage", F.lit(stage))

    tall = totals(before, "before").unionByName(totals(after, "after")).unpivot(["_stage"], columns, "metric", "_value")
    at = lambda stage: F.max(F.when(F.col("_stage") == stage, F.col("_value")))
    out = tall.groupBy("metric").agg(at("before").alias("before"), at("after").alias("after"))
    exact = {"before": F.col("before"), "after": F.col("after"), "difference": F.col("after") - F.col("before")}
    return out.select("metric", *[c.cast("double").alias(n) for n, c in exact.items()])
